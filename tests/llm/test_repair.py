"""Conversation repair against every possible edit script."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from vintage.llm import repair
from vintage.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def scripts(n):
    """Every order of n edits of rows with up to two inserts at each place."""
    adds = [(), ("u",), ("a",), ("u", "a")]
    for gaps in itertools.product(adds, repeat=n + 1):
        for edits in itertools.product(("K", "Ru", "Ra", "D"), repeat=n):
            yield gaps, edits


def plain(rows):
    """The contract, by trying all scripts. rows: (turn, role, text) in order."""
    seen, kinds, out = set(), [], dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    for _, role, text in rows:
        shown = re.sub(r"[\x20\x09-\x0D]+", "", text)
        kind = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
        seen.add((role, text))
        kinds.append(kind)
        if kind:
            out[kind] += 1
    out["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = {t for t, _, _ in rows if t is not None}
    out["gaps"] = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    best = None
    for gaps, edits in scripts(len(rows)):
        cost, audit, turns = 0, "", []
        for i, gap in enumerate(gaps):
            cost += 2 * len(gap)
            audit += "I" * len(gap)
            turns += [("user" if g == "u" else "assistant", "") for g in gap]
            if i < len(rows):
                e, (_, role, text) = edits[i], rows[i]
                if e != "D" and kinds[i] in ("blank", "duplicate"):
                    break
                cost += {"K": 0, "R": 2, "D": 3}[e[0]] + (e != "D" and kinds[i] == "truncated")
                audit += e[0]
                if e != "D":
                    turns.append(({"Ru": "user", "Ra": "assistant"}.get(e, role), text))
        else:
            if GRAMMAR.fullmatch("".join(r[:1] or "-" for r, _ in turns)) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, turns
    out["cost"], out["audit"], turns = best
    out["repaired_sha256"] = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
    return out, turns


def conversations():
    rng, rows = random.Random(7), {}
    for c in range(40):
        n = rng.randint(0, 2) if c % 2 else 3
        rows[c] = [(t, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["Yes.", "No", " ", "", "Why?\n", "a b", "é!"])) for t in range(n)]
    return rows


@pytest.mark.parametrize("piece", [512, 1])
def test_repairs_are_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(repair, "PIECE", piece)
    made = conversations()
    df = spark.createDataFrame([(c, *r) for c, rows in made.items() for r in rows], SCHEMA).repartition(5)
    found = repair.repairs(df)
    got = {r.conv_id: r.asDict() for r in found.join(repair.digests(df, found), "conv_id").collect()}
    turns = {}
    for r in repair.repaired(df, found).orderBy("conv_id", "position").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert set(got) == {c for c, rows in made.items() if rows}
    for c, rows in made.items():
        if rows:
            want, kept = plain(rows)
            assert {k: v for k, v in got[c].items() if k != "conv_id"} == want, rows
            assert turns.get(c, []) == kept, rows


def test_search_equals_plain_dynamic_programming():
    """Longer conversations: the least (cost, audit) by going row by row."""
    rng = random.Random(3)
    for n in [*range(30), 200]:
        steps = [repair.turn_steps(rng.choice("sua-"), rng.choice([repair.FINE, repair.CUT, repair.BLANK])) for _ in range(n)]
        ways = {0: (0, "")}
        for layer in [*steps, None]:
            for _ in range(2):
                for s, t, c, a in repair._ADDS:
                    if s in ways:
                        way = (ways[s][0] + c, ways[s][1] + a)
                        ways[t] = min(ways.get(t, way), way)
            after = {}
            for s, t, c, a in layer or []:
                if s in ways:
                    way = (ways[s][0] + c, ways[s][1] + a)
                    after[t] = min(after.get(t, way), way)
            ways = after if layer else ways
        assert repair.cheapest(steps, repair.START, repair.DONE, lambda i: True) == min(ways[s] for s in repair.DONE if s in ways)


def test_one_conversation_of_all_rows(spark):
    """Cut into pieces over many tasks; equal turns are merged."""
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"Text {i}.") for i in range(3000)]
    rows += [(1, 4000, "user", "again and again")] * 500 + [(1, 5000, "assistant", "x" * 300_000 + ".")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = repair.repairs(df)
    r = found.join(repair.digests(df, found), "conv_id").collect()[0]
    assert (r.duplicate, r.truncated, r.blank, r.illegal, r.gaps) == (499, 1, 0, 499, 5001 - 3002)
    assert r.audit == "K" * 3001 + "D" * 499 + "K" and r.cost == 1 + 3 * 499
    lines = [f"{x[2]}:{x[3]}" for x in rows[:3001]] + ["assistant:" + "x" * 300_000 + "."]
    assert r.repaired_sha256 == hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_nulls_empty_tables_and_extra_columns(spark):
    df = spark.createDataFrame([(None, None, None, None), (None, 1, "user", "Hi."), (2, None, "user", "Late."), (2, 0, "assistant", "Early."),
                                (3, 0, "user", "Gone.")], SCHEMA)
    df = df.withColumn("present", F.col("text") != "Gone.").withColumn("CONV", F.lit(1)).withColumn("digest", F.lit("x")).withColumn("mark", F.lit(9))
    df = df.withColumn("present", F.coalesce("present", F.lit(True)))
    found = repair.repairs(df)
    got = {r.conv_id: r for r in found.join(repair.digests(df, found).withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of"))).collect()}
    # a null role and text are one space: blank, deleted; null turns come first
    assert (got[None].blank, got[None].cost, got[None].audit, got[None].illegal, got[None].gaps) == (1, 5, "DKI", 1, 0)
    assert (got[2].audit, got[2].cost, got[2].illegal) == ("KK", 0, 0)
    assert (got[3].audit, got[3].cost, got[3].gaps) == ("", 0, 0) and got[3].repaired_sha256 == hashlib.sha256(b"").hexdigest()
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repairs(none).count() == 0 and repair.digests(none, repair.repairs(none)).count() == 0


def test_query_keeps_every_conversation(spark, tmp_path):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Turn {c} {t}.") for c in range(40) for t in range(c % 4 + 1)]
    spark.createDataFrame(rows + [(None, None, None, None)], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()
    assert {r.conv_id for r in got} == {None, *range(40)} and len(got) == 41
    assert all(r.audit == "" and r.repaired_sha256 == hashlib.sha256(b"").hexdigest() for r in got if r.conv_id is not None and not r.audit)

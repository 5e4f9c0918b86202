"""Operator 10 with its source table on Spark: the same mix as from the driver's plan."""

import pytest
from pyspark.sql import functions as F

from tapflow.llm import mixing

ROWS = [(i, "w " * (17 * i % 90), f"s{(i * i) % 13}" if i % 11 else None) for i in range(300)] + [
    (1_000 + i, "long " * 2_500, "s1") for i in range(12)] + [(2_000, None, "void"), (2_001, "", "void"), (2_002, "x", ""), (2_002, "x", "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("group", [1_000, 4])
def test_same_mix_beyond_the_bound(docs, monkeypatch, group):
    monkeypatch.setattr(mixing, "SOURCE_GROUP", group)
    small = rows(mixing.mix(docs, block_words=16)), rows(mixing.mix_blocks(docs, block_words=16))
    monkeypatch.setattr(mixing, "MAX_SOURCES", 3)
    assert rows(mixing.mix(docs, block_words=16)) == small[0]
    assert rows(mixing.mix_blocks(docs, block_words=16)) == small[1]
    # targets are met, and every shard has as many slots
    taken, want = {}, {}
    for _, source, _, _, target, n in small[0]:
        taken[source] = taken.get(source, 0) + n
        want[source] = target
    assert all(abs(taken[s] - want[s]) < 2 * 16 for s in want)
    per_shard = {}
    for r in small[1]:
        per_shard.setdefault(r[0], set()).add((r[1], r[2]))
    assert max(map(len, per_shard.values())) - min(map(len, per_shard.values())) <= 1


def test_source_table_equals_targets(spark):
    sizes = [(f"s{i:04}", (i * 7919) % 500 if i % 5 else 0) for i in range(997)] + [(None, 100_000)]
    got = mixing.source_table(spark.createDataFrame(sizes, "source string, size long"), len(sizes), mixing.WEIGHTS, 1.5, 2, 128)
    want = mixing.targets([n for _, n in sizes], [mixing.WEIGHTS[i % 3] for i in range(len(sizes))])
    assert [(r.source, r.target) for r in got.orderBy("src").collect()] == [(s, t) for (s, _), t in zip(sizes, want)]


def test_groups_are_bounded():
    assert mixing.group_size(5) == mixing.SOURCE_GROUP
    assert -(-10**9 // mixing.group_size(10**9)) <= mixing.MAX_GROUPS
    needs = mixing.group_needs([10, 0, 31], 4, 1)
    assert [sum(n) for n in needs] == [10, 0, 31]


def test_empty_table_on_spark(docs, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", -1)
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs.where(F.col("source") == "void")).count() == 2

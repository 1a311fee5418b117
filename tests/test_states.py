"""States that are kept and grow: bitmaps, trigram indexes, stored components."""

import random

import pytest
from pyspark.sql import functions as F

from sievemill.operators import rollup, search, trigram
from sievemill.operators.components import StoredComponents, connected_components


def test_states_of_parts_make_the_whole(spark):
    rng = random.Random(1)
    rows = [(k, rng.choice("abcde")) for k in range(70_000) for _ in range(rng.randint(0, 2))] + [(None, "a"), (5, None)]
    labels = spark.createDataFrame(rows, "id int, label string")
    one, other = labels.filter("id % 2 = 0"), labels.filter("id % 2 = 1 or id < 100 or id is null")
    first = rollup.numbered_rows(one, "id")
    numbers = rollup.numbered_rows(other, "id", first)
    n = numbers.count()
    assert numbers.agg(F.min("number"), F.max("number"), F.countDistinct("number")).first() == (1, n, n)
    assert numbers.join(first.withColumnRenamed("number", "was"), "id").filter("number <> was").isEmpty()
    state = rollup.merged(rollup.label_state(one, first), rollup.label_state(other, numbers))
    known = [(i, c) for i, c in rows if i is not None and c is not None]
    assert {r.code: r.n for r in rollup.counts(state).collect()} == {c: len({i for i, d in known if d == c}) for c in "abcde"}
    dimension = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("q", "y"), ("q", "z")], "code string, major_code string")
    got = {(r.level, r.code): r.n for r in rollup.rolled_up(state, dimension).collect()}
    ids = lambda codes: len({i for i, d in known if d in codes})
    assert got == {("sub", "a"): ids("a"), ("sub", "b"): ids("b"), ("sub", "c"): ids("c"), ("sub", "q"): 0, ("major", "x"): ids("ab"), ("major", "y"): ids("c"), ("major", "z"): 0, ("total", ""): ids("abc")}
    assert rollup.rolled_up(rollup.label_state(labels.limit(0), first), dimension).filter("n > 0").isEmpty()


NAMES = ["Alpha Atlas", "alphabet soup", "100% beta_x", "a\\b slash", "Ünïcode Straße", "ab", "", None, "new\nline atlas", "tail beta yx", "日本語テキスト", "𝒜𝓑𝒞 wide"]


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    rows = [(k, NAMES[k % len(NAMES)] if k < 60 else f"filler number {k}", bool(k % 2), float(k)) for k in range(400)]
    df = spark.createDataFrame(rows, "id int, name string, live boolean, score double").repartition(3)
    meta = spark.createDataFrame([("name", "main", 0), ("live", "expand", 1), ("score", "main", 2), ("id", "hidden", 3)], "column_name string, display_group string, order_index int")
    folder = f"file://{tmp_path_factory.mktemp('trigram')}/index"
    trigram.build(df, folder, ["id"], meta, rows=20)
    return df, meta, folder


@pytest.mark.parametrize("keyword", ["atlas", "ATLAS", "alpha%soup", "beta_x", "a\\b", "Straße", "STRASSE", "ab", "%", "_", "", "9.0", "filler number 39", "er_number%7", "日本語", "𝓑𝒞 w", "nothing like it", "new\nline", "l%r", "100%"])
def test_the_index_finds_what_a_search_finds(spark, catalog, keyword):
    df, meta, folder = catalog
    want = sorted(r.id for r in df.filter(search.keyword_predicate(df, search.visible_columns(df, meta), keyword)).collect())
    got = trigram.find(spark, folder, keyword)
    assert got.columns == df.columns and sorted(r.id for r in got.collect()) == want


def test_only_candidate_blocks_are_read(spark, catalog):
    df, _, folder = catalog
    blocks = trigram.candidate_blocks(spark, folder, "filler number 39")
    assert 1 <= len(blocks) <= 6 and trigram.candidate_blocks(spark, folder, "fi%39") is None and trigram.candidate_blocks(spark, folder, "zzz") == []
    found = trigram.find(spark, folder, "filler number 39")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_block" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = spark.read.parquet(f"{folder}/rows").filter(F.col(trigram.BLOCK).isin(blocks)).select(F.input_file_name().alias("f")).distinct().collect()
    assert {int(r.f.split("_block=")[1].split("/")[0]) for r in read} == set(blocks)
    with pytest.raises(ValueError, match="no index"):
        trigram.find(spark, f"{folder}-none", "abc")


def plain_components(edges):
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        top[b] = a
    return {x: find(x) for x in top}


def test_batches_lead_to_the_components_of_all_edges(spark, tmp_path):
    rng = random.Random(8)
    stored = StoredComponents(spark, f"file://{tmp_path}/graph")
    assert stored.labels() is None
    frame = lambda e: spark.createDataFrame(e, "src long, dst long")
    edges, n = [], 0
    for batch in range(4):
        new = [(a, a + rng.choice((0, 1, 40))) for a in (rng.randrange(300) for _ in range(60))] + [(None, 3), (4, None)]
        counted = stored.add(frame(new), f"b{batch}")
        edges += [(u, v) for u, v in new if u is not None and v is not None]
        n += counted["members"]
        assert {r.id: r.component for r in stored.labels().collect()} == plain_components(edges)
    assert n == len(plain_components(edges)) and stored.add(frame(edges), "b2") == {"ends": 0, "members": 0, "moved": 0}
    whole = {r.id: r.component for r in connected_components(frame(edges)).collect()}
    assert whole == {r.id: r.component for r in stored.labels().collect()}
    assert {r.id for r in stored.labels(spark.createDataFrame([(edges[0][0],), (9999,)], "id long")).collect()} == {edges[0][0]}


def test_the_work_follows_the_batch(spark, tmp_path):
    stored = StoredComponents(spark, f"file://{tmp_path}/graph")
    big = spark.range(20_000).select(F.col("id").alias("src"), (F.col("id") - F.col("id") % 10).alias("dst"))
    assert stored.add(big, "old") == {"ends": 20_000, "members": 20_000, "moved": 0}
    one = spark.createDataFrame([(15, 27), (27, 90_000)], "src long, dst long")
    assert stored.add(one, "new") == {"ends": 3, "members": 1, "moved": 1}
    assert stored.add(spark.createDataFrame([(3, 11)], "src long, dst long"), "last") == {"ends": 2, "members": 0, "moved": 2}
    got = {r.id: r.component for r in stored.labels().filter("component = 0").collect()}
    assert set(got) == {*range(10), *range(10, 20), *range(20, 30), 90_000}


def test_a_batch_that_was_stopped_counts_for_nothing(spark, tmp_path):
    stored = StoredComponents(spark, f"file://{tmp_path}/graph")
    frame = lambda *e: spark.createDataFrame(list(e), "src long, dst long")
    stored.add(frame((1, 2)), "a")
    stored._write("members", "b", spark.createDataFrame([(7, 7)], "id long, label long"))  # as if stopped before the batch was noted
    assert {r.id for r in stored.labels().collect()} == {1, 2}
    stored.add(frame((2, 3)), "b")
    assert {r.id: r.component for r in stored.labels().collect()} == {1: 1, 2: 1, 3: 1}

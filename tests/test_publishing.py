"""Publishing together, harvests that ask once, and a rate that all tasks share."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from sievemill.operators import catalog
from sievemill.sources import harvest, published, services, shared_tables


def test_readers_never_see_two_versions(spark, tmp_path):
    folder, mixed, seen, over = f"file://{tmp_path}/catalog", [], set(), threading.Event()
    frame = lambda n: spark.createDataFrame([(n,)], "n int")
    with pytest.raises(LookupError):
        published.pinned(spark, folder)
    catalog.publish(frame(0), frame(0), folder)

    def reader():
        while not over.is_set():
            rows, meta = catalog.published(spark, folder)
            a, b = rows.first().n, meta.first().n
            seen.add(a)
            if a != b:
                mixed.append((a, b))

    thread = threading.Thread(target=reader)
    thread.start()
    versions = [catalog.publish(frame(k), frame(k), folder) for k in range(1, 21)]
    over.set()
    thread.join()
    assert not mixed and len(seen) > 2 and versions == list(range(2, 22)) and published.latest(spark, folder) == 21
    assert catalog.published(spark, folder, 19)[0].first().n == 18
    with pytest.raises(LookupError, match="version 3"):
        catalog.published(spark, folder, 3)
    assert len(list((tmp_path / "catalog" / "data").iterdir())) == 3


def test_small_files_are_replaced_or_made_once(spark, tmp_path):
    path = f"file://{tmp_path}/x.json"
    for k in range(3):
        shared_tables.write_text(spark, path, str(k))
        assert shared_tables.read_saved(spark, path) == str(k)
    assert not shared_tables.create_text(spark, path, "new") and shared_tables.read_text(spark, path) == "2"
    assert shared_tables.create_text(spark, f"{path}-2", "new") and not [p for p in tmp_path.iterdir() if p.name not in ("x.json", "x.json-2") and not p.name.endswith(".crc")]


class Pages:
    """A service that answers from files, notes every request, and may fail at one of them."""

    def __init__(self, folder, articles, fail=None):
        self.folder, self.articles, self.fail = folder, articles, fail

    def __call__(self, request):
        year = int(request["query"].rsplit(" ", 1)[1].rstrip("]"))
        start = 0 if request["cursorMark"] == "*" else int(request["cursorMark"].split("-")[1])
        if self.fail == (year, start) and not (self.folder / "failed").exists():
            (self.folder / "failed").touch()
            raise OSError("lost")
        with (self.folder / "asked.jsonl").open("a") as f:
            f.write(json.dumps([year, start, time.time()]) + "\n")
        own = [a for a in self.articles if a["year"] == year]
        end = min(start + request["pageSize"], len(own))
        return {"resultList": {"result": [{"title": a["title"], "pmid": a["id"], "id": a["id"]} for a in own[start:end]]}, "nextCursorMark": f"c-{end}"}

    def asked(self):
        return [tuple(json.loads(x)[:2]) for x in (self.folder / "asked.jsonl").read_text().splitlines()]


@pytest.fixture(scope="module")
def articles(spark, sf):
    rows = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").orderBy("page_id").collect()
    return [{"id": str(r.page_id), "title": r.url, "year": 2019 + r.page_id % 3} for r in rows]


def test_a_harvest_goes_on_where_it_was_lost(spark, articles, tmp_path):
    service = Pages(tmp_path, articles, fail=(2020, 3))
    folder = f"file://{tmp_path}/answers"
    found = harvest.search_years(spark, service, folder, "q", [2019, 2020, 2021], page_size=3)
    with pytest.raises(Exception, match="lost"):
        found.collect()
    rows = harvest.search_years(spark, service, folder, "q", [2019, 2020, 2021], page_size=3).collect()
    assert sorted(r.pmid for r in rows) == sorted(a["id"] for a in articles)
    n = len(service.asked())
    assert n == len(set(service.asked())) and found.count() == len(articles) and len(service.asked()) == n
    by_pos = [r.pmid for r in sorted(rows, key=lambda r: r.pos)]
    assert by_pos == [a["id"] for y in (2019, 2020, 2021) for a in articles if a["year"] == y]
    plain = services.search_years(spark, Pages(tmp_path, articles), "q", [2019, 2020, 2021], None, 3)
    assert plain.columns == found.columns and plain.drop("pos").exceptAll(found.drop("pos")).isEmpty()
    few = harvest.search_years(spark, service, f"{folder}-few", "q", [2019, 2020], most=4, page_size=3)
    assert {(r.year_window, r["count"]) for r in few.groupBy("year_window").count().collect()} == {(2019, 4), (2020, 4)}


def test_a_stream_of_pages_is_restarted(spark, articles, tmp_path):
    service = Pages(tmp_path, articles, fail=(2021, 5))
    spark.dataSource.register(harvest.source(service))
    options = harvest.options_of("q", [2019, 2020, 2021], 5)

    def run(batches):
        stream = spark.readStream.format(harvest.FORMAT).options(**options).load(f"file://{tmp_path}/answers")
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"file://{tmp_path}/state").option("path", f"file://{tmp_path}/out").trigger(processingTime="100 milliseconds").start()
        try:
            until = time.time() + 120
            while time.time() < until and query.isActive and spark_rows() < batches:
                time.sleep(0.2)
            if query.exception() is not None:
                raise RuntimeError(str(query.exception()))
        finally:
            query.stop()

    def spark_rows():
        try:
            return spark.read.schema(harvest.SCHEMA).parquet(f"file://{tmp_path}/out").count()
        except Exception:
            return 0

    with pytest.raises(RuntimeError, match="lost"):
        run(len(articles))
    assert 0 < spark_rows() < len(articles)
    run(len(articles))
    out = spark.read.parquet(f"file://{tmp_path}/out")
    assert sorted(r.pmid for r in out.collect()) == sorted(a["id"] for a in articles)
    assert len(service.asked()) == len(set(service.asked()))


class Timed:
    def __init__(self, folder):
        self.folder = folder

    def __call__(self, request):
        with (self.folder / "asked.jsonl").open("a") as f:
            f.write(f"{time.time()}\n")
        return {"referenceList": {"reference": []}}


@pytest.mark.parametrize("partitions", [2, 50])
def test_all_tasks_share_one_rate(spark, tmp_path, partitions):
    pmids = spark.range(150).select(F.col("id").cast("string").alias("pmid")).repartition(partitions)
    assert services.fetch_references(pmids, Timed(tmp_path), rate=40).count() == 0
    times = sorted(map(float, (tmp_path / "asked.jsonl").read_text().split()))
    assert len(times) == 150
    middle = times[10:90]  # while all tasks have rows
    assert 0.9 * 40 <= (len(middle) - 1) / (middle[-1] - middle[0]) <= 1.1 * 40

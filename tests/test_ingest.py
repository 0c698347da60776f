import hashlib
import json
import os
import random
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import gatelens as g
from gatelens.functions.documents import parse_timestamp
from gatelens.functions.time import to_millis
from gatelens.operators import logs
from gatelens.sources import bulk, tables
from gatelens.sources.tables import scan, scan_span

DAY1, DAY2 = "2017.05.22", "2017.05.23"


def action(doc_type, doc_id, day=DAY1):
    return json.dumps({"index": {"_index": f"traffic-{day}", "_type": doc_type, "_id": doc_id}}, separators=(",", ":"))


def request(doc_id, day=DAY1, end="\n", **fields):
    stamp = f"{day.replace('.', '-')}T18:10:11.079+01:00"
    document = {"@timestamp": stamp, "api": "a", "method": 3, "status": 200, "response-time": 5, **fields}
    return action("request", doc_id, day) + end + json.dumps(document) + end


@pytest.fixture()
def store(spark, tmp_path):
    return g.GatewayStore(spark, str(tmp_path / "store"))


@pytest.fixture()
def feed(tmp_path):
    def save(name, *records):
        (tmp_path / "feed").mkdir(exist_ok=True)
        path = tmp_path / "feed" / name
        path.write_text("".join(records), newline="")
        return str(path)

    return save


def statuses(store):
    return {(r.day, r.id): r.status for r in store.documents("request").collect()}


def test_types_and_names(spark, store, feed):
    path = feed("one.json", request("r1", **{"api-response-time": 4, "status": 404}))
    assert store.ingest(path) == ["request"]
    row = store.documents("request").first()
    assert row.ts == datetime(2017, 5, 22, 17, 10, 11, 79000)
    assert (row.id, row.day, row.method, row.status, row.response_time, row.api_response_time) == ("r1", DAY1, "3", 404, 5, 4)
    assert row.application is None
    assert store.documents("request").schema == tables.table_schema("request")


def test_last_action_wins_within_a_file(store, feed):
    store.ingest(feed("one.json", *[request("r1", status=s) for s in range(200, 240)], request("r2", status=500)))
    assert statuses(store) == {(DAY1, "r1"): 239, (DAY1, "r2"): 500}


def test_a_bulk_request_as_a_string(store):
    assert store.index(request("r1") + request("r2", end="\r\n") + request("r1", status=404)) == ["request"]
    assert statuses(store) == {(DAY1, "r1"): 404, (DAY1, "r2"): 200}


def test_later_file_wins(store, feed):
    late, early = feed("b.json", request("r1", status=201)), feed("a.json", request("r1", status=202))
    store.ingest(late, early)  # in the order given, whatever the names
    assert statuses(store) == {(DAY1, "r1"): 202}
    store.ingest(early, late)
    assert statuses(store) == {(DAY1, "r1"): 201}


def test_older_file_of_a_folder_comes_first(store, feed, tmp_path):
    for age, name in enumerate(("feed-10", "feed-9", "feed-11")):
        os.utime(feed(name, request("r1", status=201 + age)), (1_000_000_000 + age, 1_000_000_000 + age))
    store.ingest(str(tmp_path / "feed"))
    assert statuses(store) == {(DAY1, "r1"): 203}


def test_upsert_over_days(spark, store, feed):
    store.ingest(feed("1.json", request("r1"), request("r2"), request("r3", DAY2), request("r4", "2017.05.24")))
    untouched = scan(spark, store.root, "request", [DAY2]).inputFiles()
    # One id comes again, one is new on the same day, one opens a day, and an id of another day is another document.
    store.ingest(feed("2.json", request("r1", status=500), request("r5"), request("r2", "2017.05.25"), request("r6", "2017.05.24")))
    assert statuses(store) == {
        (DAY1, "r1"): 500, (DAY1, "r2"): 200, (DAY1, "r5"): 200, (DAY2, "r3"): 200,
        ("2017.05.24", "r4"): 200, ("2017.05.24", "r6"): 200, ("2017.05.25", "r2"): 200,
    }
    assert scan(spark, store.root, "request", [DAY2]).inputFiles() == untouched


def test_same_batch_again_writes_nothing(store, feed):
    headers = {"X": ["1"], "Y": ["2", "3"]}
    path = feed("1.json", request("r1", **{"client-request-headers": headers}), request("r2", DAY2))
    store.ingest(path)
    before, files = statuses(store), store.documents("request").inputFiles()
    store.ingest(path)
    assert statuses(store) == before
    assert sorted(store.documents("request").inputFiles()) == sorted(files)


def test_repeated_and_new_rows_are_told_apart(store, feed):
    store.ingest(feed("1.json", request("r1"), request("r2", DAY2), request("r3", DAY2)))
    files = set(store.documents("request").inputFiles())
    # The first day only repeats and grows; on the second a document changes.
    store.ingest(feed("2.json", request("r1"), request("r4"), request("r2", DAY2), request("r3", DAY2, status=500)))
    assert statuses(store) == {(DAY1, "r1"): 200, (DAY1, "r4"): 200, (DAY2, "r2"): 200, (DAY2, "r3"): 500}
    kept = files & set(store.documents("request").inputFiles())
    # Appended to, not rewritten; and of the second day, which is small, the one part.
    changed = f"day={DAY2}/bucket=-1/"
    assert kept == {f for f in files if changed not in f} and any(changed in f for f in files)


# --- parts of a day ---


def files_by_part(store, doc_type="request"):
    found = {}
    for file in store.documents(doc_type).inputFiles():
        found.setdefault(tuple(file.split("/")[-3:-1]), set()).add(file)
    return found


def lengthy(n, **fields):
    """A document of some bytes that don't compress."""
    return request(f"r{n}", fields.pop("day", DAY1), transaction=hashlib.sha512(str((n, sorted(fields.items()))).encode()).hexdigest(), **fields)


@pytest.fixture()
def small_files(monkeypatch):
    monkeypatch.setattr(tables, "FILE_BYTES", 20_000)


def test_a_large_day_is_cut_and_an_update_rewrites_one_part(store, feed, small_files):
    store.ingest(feed("1.json", *[lengthy(n) for n in range(1_500)]))
    before = files_by_part(store)
    assert len(before) >= 4 and all(part[1].startswith("bucket=-") for part in before)
    store.ingest(feed("2.json", request("r7", status=404)))
    after = files_by_part(store)
    changed = {part for part in before if after.get(part) != before[part]}
    assert len(changed) == 1 and len(before[changed.pop()]) == 1
    assert statuses(store) == {(DAY1, f"r{n}"): 404 if n == 7 else 200 for n in range(1_500)}


def test_parts_grow_with_their_day(store, feed, small_files):
    """Batch by batch, with repeats and changes: parts that outgrow a file are split, all rows stay what was sent last."""
    rng, want, seen = random.Random(3), {}, []
    for turn in range(6):
        ids = [rng.randrange(2_500) for _ in range(400 if turn % 2 else 700)]
        records = []
        for n in ids:
            status = rng.choice([200, 404, 500])
            want[DAY1, f"r{n}"] = status
            records.append(lengthy(n, status=status))
        store.ingest(feed(f"{turn}.json", *records))
        assert statuses(store) == want and store.documents("request").count() == len(want)
        seen.append(len(files_by_part(store)))
    assert seen[-1] > seen[0] >= 1
    labels = [int(bucket.removeprefix("bucket=")) for _, bucket in files_by_part(store)]
    for part in labels:  # no part lies in another
        while part < -1:
            part = -(-part - ((1 << tables.depth_of(part)) >> 1) * (1 if tables.low_bits(part) < (1 << tables.depth_of(part)) >> 1 else 2))
            assert part not in labels


def test_days_of_earlier_versions(spark, store, feed, small_files):
    """Quarters 0 to 3 are read, added to, changed and split."""
    path = feed("1.json", *[lengthy(n) for n in range(300)])
    typed = bulk.typed_rows(bulk.parse_bulk(bulk.read_bulk(spark, path)), "request")
    tables.write(typed.withColumn("bucket", tables.quarter()), tables.table_path(store.root, "request"), "request")
    old = files_by_part(store)
    assert set(old) == {(f"day={DAY1}", f"bucket={n}") for n in range(4)}
    store.ingest(feed("2.json", request("r7", status=404), request("new")))
    assert statuses(store) == {(DAY1, f"r{n}"): 404 if n == 7 else 200 for n in range(300)} | {(DAY1, "new"): 200}
    assert sum(files_by_part(store).get(part) == files for part, files in old.items()) >= 2
    store.ingest(feed("3.json", *[lengthy(n) for n in range(100, 2_000)]))
    assert statuses(store) == {(DAY1, f"r{n}"): 404 if n == 7 else 200 for n in range(2_000)} | {(DAY1, "new"): 200}
    assert len(files_by_part(store)) > 4 and store.documents("request").count() == 2_001


def test_an_id_whose_part_is_empty(spark, store):
    """A deep layout with few rows: ids of absent parts are added and found again."""
    rows = lambda ids, status: bulk.typed_rows(bulk.parse_bulk(bulk.text_records(spark, "".join(request(i, status=status) for i in ids))), "request")
    first = rows(["r1", "r2"], 200).withColumn("bucket", F.when(F.col("id") == "r1", tables.part_at(5)).otherwise(tables.part_at(7)))
    tables.write(first, tables.table_path(store.root, "request"), "request")
    tables.upsert(rows([f"r{n}" for n in range(40)], 404), store.root, "request")
    tables.upsert(rows([f"r{n}" for n in range(20)], 500), store.root, "request")
    assert statuses(store) == {(DAY1, f"r{n}"): 500 if n < 20 else 404 for n in range(40)}
    assert store.documents("request").count() == 40


def test_a_driver_lost_in_a_swap(store, feed, monkeypatch, small_files):
    """Before the swap nothing has changed; in its middle a finished stage waits for the next upsert."""
    store.ingest(feed("1.json", *[lengthy(n) for n in range(400)]))
    real = tables.swap

    def lost(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(tables, "swap", lost)
    with pytest.raises(KeyboardInterrupt):
        store.ingest(feed("2.json", *[lengthy(n, status=404) for n in range(900)]))
    held = statuses(store)
    assert {held[DAY1, f"r{n}"] for n in range(400)} == {200}

    def half(spark, path, stage):
        """Moves one part, then fails."""
        jvm, (files, _) = spark._jvm, tables.file_system(spark, stage)
        moved = []
        rename = lambda a, b: moved.append(a) or (len(moved) < 2 and files.rename(a, b))

        class Limited:
            def __getattr__(self, name):
                return rename if name == "rename" else getattr(files, name)

        monkeypatch.setattr(tables, "file_system", lambda s, p: (Limited(), jvm.org.apache.hadoop.fs.Path(p)))
        real(spark, path, stage)

    whole = tables.file_system
    monkeypatch.setattr(tables, "swap", half)
    with pytest.raises(OSError):
        store.ingest(feed("3.json", request("other")))
    monkeypatch.setattr(tables, "file_system", whole)
    monkeypatch.setattr(tables, "swap", real)
    store.ingest(feed("4.json", request("last")))
    assert {key: status for key, status in statuses(store).items() if key[1] not in ("other", "last")} == {(DAY1, f"r{n}"): 404 for n in range(900)}
    assert store.documents("request").count() == len(statuses(store))


def test_possible_parts_hold_every_layout(spark):
    ids = spark.range(200).select(F.col("id").cast("string").alias("id"), F.lit(DAY1).alias("day"))
    layouts = [{DAY1: [0, 1, 2, 3]}, {DAY1: [-1]}, {DAY1: [-2, -5, -11, -15]}, {DAY1: [1, 3, -8, -12, -6]}, {}]
    for stored in layouts:
        placed = ids.select("id", tables.part_of(stored, {DAY1: 3}).alias("part"), tables.possible_parts().alias("parts")).collect()
        assert all(r.part in r.parts for r in placed)
        if stored:
            assert {r.part for r in placed} == set(stored[DAY1])
    assert [tables.halvings(n * tables.FILE_BYTES) for n in (0, 1, 2, 3, 4, 5, 8, 9)] == [0, 0, 1, 2, 2, 3, 3, 4]


def files_read(frame, column=""):
    """Files that the scans with this column opened."""
    frame.collect()
    found, todo = 0, [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec" and column in node.toString():
            found += node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(n) for n in range(children.size())]
    return found


def test_lookups_open_the_parts_of_their_ids(spark, store, feed, monkeypatch):
    """Requests, payloads and health checks, by list and by frame, whatever parts their days have."""
    monkeypatch.setattr(tables, "FILE_BYTES", 4_000)
    log = lambda i, day: action("log", i, day) + "\n" + json.dumps({"client-response": {"status": 201, "body": hashlib.sha512(i.encode()).hexdigest()}}) + "\n"
    health = lambda i, day: action("health", i, day) + "\n" + json.dumps({"@timestamp": "2017-05-22T10:00:00Z", "api": hashlib.sha512(i.encode()).hexdigest()}) + "\n"
    records = []
    for day, n_docs in ((DAY1, 900), (DAY2, 300)):
        for n in range(n_docs):
            records += [lengthy(n, day=day), log(f"r{n}", day), health(f"r{n}", day)]
    store.ingest(feed("1.json", *records))
    parts = {kind: len(files_by_part(store, kind)) for kind in ("request", "log", "health")}
    assert min(parts.values()) >= 5
    for ids in (["r7"], spark.createDataFrame([("r7",)], "id string")):
        found = store.find_requests(ids)
        assert sorted((r.day, r.id, r.client_response.status) for r in found.collect()) == [(DAY1, "r7", 201), (DAY2, "r7", 201)]
        assert files_read(store.find_requests(ids, strict=False), "client_response") == 2
        assert files_read(store.find_requests(ids, strict=False), "api_response_time") in (2, 4)  # once, or for the days too
        assert store.find_health(ids).count() == 2 and files_read(store.find_health(ids, strict=False)) == 2
    everything = [f"r{n}" for n in range(900)]
    assert store.find_requests(everything).count() == 1_200
    assert store.find_requests(["nobody"], strict=False).collect() == []


def test_deep_pages_skip_by_time(spark, store, feed, monkeypatch):
    """The ends of the minutes found are filters of the next scans."""
    rows = [request(f"r{n:04}", **{"@timestamp": f"2017-05-22T{n // 100:02}:{n % 60:02}:00Z"}) for n in range(2_000)]
    store.ingest(feed("1.json", *rows))
    monkeypatch.setattr(logs, "TOP_K_ROWS", 0)
    page = store.tabular(g.between(datetime(2017, 5, 22), datetime(2017, 5, 23)), page=30, size=10)
    key = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(key)
    spark.conf.set(key, "5000")
    got = [(r.id, r.total) for r in page.collect()]
    order = sorted(range(2_000), key=lambda n: (n // 100, n % 60, n), reverse=True)
    assert got == [(f"r{n:04}", 2_000) for n in order[290:300]]
    scans = [line for line in page._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    spark.conf.set(key, before)
    assert any("GreaterThanOrEqual(ts,ScalarSubquery" in line.partition("PushedFilters")[2] for line in scans)


def test_pages_of_a_store(store, feed):
    store.ingest(feed("1.json", *[request(f"r{n:03}", **{"@timestamp": f"2017-05-22T10:00:{n % 60:02}Z"}) for n in range(130)]))
    span = g.between(datetime(2017, 5, 22), datetime(2017, 5, 23))
    pages = store.tabular_pages(span, size=50)
    for page in (1, 2, 3):
        assert [r.id for r in pages.page(page).collect()] == [r.id for r in store.tabular(span, page, 50).collect()]
    assert store.health_log_pages("a", now=to_millis(datetime(2017, 5, 23))).all().count() == 0


def test_histograms_of_a_store_come_in_pieces(store, feed):
    store.ingest(feed("1.json", *[request(f"r{n:03}", **{"@timestamp": f"2017-05-22T10:{n % 60:02}:00Z"}) for n in range(120)]))
    span = g.between(datetime(2017, 5, 22, 9), datetime(2017, 5, 22, 12))
    wanted = [g.avg("response-time"), g.avg("proxy-latency")]
    row = store.date_histogram_response(span, 1_000, wanted).first()
    chunks = store.date_histogram(span, 1_000, wanted)
    pieces = [r for r in chunks.collect() if r.slot == 0]
    assert len(pieces) > 1 and max(len(r.points) for r in pieces) <= 1_000
    assert [p for r in sorted(pieces, key=lambda r: r.chunk_start) for p in r.points] == row["values"][0].data["avg_response-time"]
    assert [(r.key, r.points) for r in chunks.collect() if r.slot == 1] == [(None, None)] and row["values"][1] is None
    axis = sorted(store.histogram_axis(span, 1_000).collect(), key=lambda r: r.chunk_start)
    assert len(axis) == 12 and [t for r in axis for t in r.timestamps] == row.timestamps
    with pytest.raises(ValueError):
        store.date_histogram_response(g.between(datetime(2017, 1, 1), datetime(2017, 2, 1)), 1, wanted)


def test_rejects_are_kept_by_day_and_read_by_day(spark, store, feed, tmp_path):
    old = feed("old.json", action("request", "r1") + "\n{\n", request("r0"))
    os.utime(old, (1_500_000_000, 1_500_000_000))
    store.ingest(old)
    store.ingest(feed("new.json", action("request", "r2") + "\n{\n", "{}\n{}\n"))
    store.ingest(old), store.ingest(feed("new.json", action("request", "r2") + "\n{\n", "{}\n{}\n"))
    days = {name for name in os.listdir(f"{store.root}/rejected") if name.startswith("day=")}
    assert len(days) == 2 and "day=2017.07.14" in days
    assert sum(r.id == "r1" for r in store.rejects().collect()) == 1
    known = bulk.known_places(spark, store.root, {"2017.07.14"}, ["file:/x"])
    text = known._jdf.queryExecution().executedPlan().toString()
    assert "2017.07.14" in text.partition("PartitionFilters: [")[2].partition("]")[0]
    assert "EqualTo(file,file:/x)" in text or "In(file" in text


def test_rejects_of_earlier_versions_are_still_listed(spark, store, feed):
    store.ingest(feed("1.json", action("request", "r1") + "\n{\n", request("r0")))
    store.rejects().write.parquet(f"{store.root}/rejects")
    assert store.rejects().count() == 2


def test_windows_line_ends_and_blank_start(store, feed):
    store.ingest(feed("1.json", "\n", request("r1", end="\r\n"), request("r2", end="\r\n", status=201)))
    assert statuses(store) == {(DAY1, "r1"): 200, (DAY1, "r2"): 201}


def test_files_are_split_between_records(spark, store, feed):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    records = [request(f"r{n % 300}", status=200 + n // 300, uri="/x" * (n % 50)) for n in range(900)]
    path = feed("1.json", *records)
    spark.conf.set(key, "4096")
    try:
        assert bulk.read_bulk(spark, path).rdd.getNumPartitions() > 4
        store.ingest(path)
    finally:
        spark.conf.set(key, before)
    assert statuses(store) == {(DAY1, f"r{n}"): 202 for n in range(300)}


def test_timestamp_texts(spark):
    noon = to_millis(datetime(2017, 5, 22, 12))
    texts = {
        "2017-05-22T13:00:00.079+01:00": noon + 79,
        "2017-05-22T12:00:00.079Z": noon + 79,
        "2017-05-22T10:30:00.000-0130": noon,
        "2017-05-22T12:00:00Z": noon,
        "2017-05-22T12:00:00.5": noon + 500,
        "2017-05-22": noon - 12 * 3_600_000,
        str(noon): noon,
        "-1": -1,
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        frame = spark.createDataFrame([(text,) for text in texts], "text string")
        rows = frame.select("text", F.unix_millis(parse_timestamp(F.col("text"))).alias("ms")).collect()
        assert {r.text: r.ms for r in rows} == texts
        assert frame.limit(1).select(parse_timestamp(F.lit(None).cast("string")).alias("t")).first().t is None
        for bad in ("yesterday", "2017-13-01", "12:00", ""):
            with pytest.raises(Exception, match="not a timestamp"):
                frame.limit(1).select(parse_timestamp(F.concat(F.lit(bad), F.substring("text", 1, 0)))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "records",
    [
        action("request", "r1") + "\n",
        action("request", "r1") + "\n" + '{"status": \n',
        action("unknown", "r1") + "\n{}\n",
        '{"index":{"_index":"traffic-2017.05.22","_type":"request"}}\n{}\n',
        '{"index":{"_index":"traffic","_type":"request","_id":"r1"}}\n{}\n',
        "nonsense\n{}\n",
        request("r1", **{"@timestamp": "yesterday"}),
    ],
)
def test_unusable_records_fail(store, feed, records):
    path = feed("1.json", request("r0"), records)
    with pytest.raises(Exception, match="unusable bulk record"):
        store.ingest(path, on_error="fail")
    assert store.documents("request").count() == 0
    # Set aside, it keeps no other record from being stored, and a second time it is known.
    for _ in range(2):
        assert store.ingest(path) == ["request"]
        assert list(statuses(store)) == [(DAY1, "r0")] and store.rejects().count() == 1
    assert store.rejects().first().file.endswith("1.json")


def test_no_action_at_all(store, feed):
    with pytest.raises(Exception, match="unusable bulk record"):
        store.ingest(feed("1.json", "nonsense\n{}\n"), on_error="fail")
    assert store.ingest(feed("1.json", "nonsense\n{}\n")) == []


def test_a_bad_document_does_not_replace_a_good_one(store, feed):
    store.ingest(feed("1.json", request("r1", status=201), request("r1", status=70000), request("r2", **{"@timestamp": "soon"})))
    assert statuses(store) == {(DAY1, "r1"): 201}
    assert sorted((r.reason, r.id) for r in store.rejects().collect()) == [("bad timestamp", "r2"), ("unreadable document", "r1")]


def spaced(record, how='{ "index" : '):
    return record.replace('{"index":', how, 1)


def test_any_spacing_of_actions(spark, store, feed):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    records = [request(f"r{n}", status=200 + n) for n in range(200)]
    path = feed("1.json", *[spaced(r) if n % 50 else spaced(r, '{"index" :') for n, r in enumerate(records)])
    spark.conf.set(key, "2048")
    try:
        assert bulk.read_bulk(spark, path).rdd.getNumPartitions() > 4
        store.ingest(path)
    finally:
        spark.conf.set(key, before)
    assert statuses(store) == {(DAY1, f"r{n}"): 200 + n for n in range(200)}


def test_changes_below_the_millisecond_are_no_changes(store, feed):
    for micros in ("000100", "000900", "001000"):
        store.ingest(feed("1.json", request("r1", **{"@timestamp": f"2017-05-22T10:00:00.{micros}Z"})))
        stored = store.documents("request").first().ts
        assert stored.microsecond == int(micros) // 1000 * 1000


def test_all_types(spark, store, feed):
    headers = {"X-User": ["7"]}
    log = {"client-request": {"uri": "/u", "method": "GET", "body": "{}", "headers": headers}, "client-response": {"status": 201}}
    check = {
        "@timestamp": "2017-05-22T17:00:00.000Z", "api": "a", "endpoint": "e", "available": True, "success": True, "state": 1,
        "response-time": 3, "steps": [{"success": True, "message": None, "request": {"uri": "/n", "method": "GET"}, "response": {"status": 200}}],
    }
    old_check = {
        "@timestamp": "2017-05-22T18:00:00.000Z", "api": "a", "status": 503, "url": "/old", "method": "get",
        "success": False, "state": 0, "message": "late",
    }
    path = feed(
        "1.json",
        request("r1"),
        action("log", "r1") + "\n" + json.dumps(log) + "\n",
        action("health", "h1") + "\n" + json.dumps(check) + "\n",
        action("health", "h2") + "\n" + json.dumps(old_check) + "\n",
        action("monitor", "m1") + "\n" + json.dumps({"@timestamp": "2017-05-22T17:00:00.000Z", "gateway": "g"}) + "\n",
    )
    assert store.ingest(path) == ["health", "log", "monitor", "request"]
    found = store.find_requests(["r1"]).first()
    assert (found.client_request.headers, found.client_response.status, found.proxy_request) == (headers, 201, None)
    now = g.between(datetime(2017, 5, 22, 20), datetime(2017, 5, 22, 20)).end
    logs = store.health_logs("a", now=now).collect()
    assert [(r.id, r.uri, r.method, r.status) for r in logs] == [("h2", "/old", "GET", 503), ("h1", "/n", "GET", 200)]
    counted = store.all_types().groupBy("doc_type").count()
    assert {r.doc_type: r["count"] for r in counted.collect()} == {"request": 1, "log": 1, "health": 2, "monitor": 1}


def test_scans_prune_and_forgive(spark, store, feed):
    assert store.documents("request").count() == 0  # no table yet
    store.ingest(feed("1.json", request("r1"), request("r2", DAY2), request("r3", "2017.05.30")))
    assert store.named_days("request", [DAY1, "1999.01.01"]).count() == 1
    assert store.named_days("request", ["1999.01.01"]).count() == 0
    assert store.named_days("request", []).count() == 0
    span = g.between(datetime(2017, 5, 22, 23), datetime(2017, 5, 23, 1))
    docs = store.documents("request", span)
    assert len(docs.inputFiles()) == 2 and docs.count() == 2
    wide = scan_span(spark, store.root, "request", datetime(2010, 1, 1).date(), datetime(2017, 5, 23).date())
    assert wide.count() == 2
    with pytest.raises(ValueError):
        store.documents("metrics")


def test_pushdown_and_statistics(spark, store, feed):
    store.ingest(feed("1.json", request("r1"), request("r2", DAY2)))
    span = g.between(datetime(2017, 5, 22), datetime(2017, 5, 22, 12))
    plan = g.group_by(store.documents("request", span), "application", span, root=("api", "a"))
    text = spark._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(day" in text
    assert "EqualTo(api,a)" in text and "GreaterThanOrEqual(ts" in text
    assert "ReadSchema: struct<ts:timestamp,api:string,application:string>" in text
    import pyarrow.parquet as pq

    file = store.documents("request").inputFiles()[0].removeprefix("file:").replace("//", "/")
    meta = pq.ParquetFile(file).metadata
    columns = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i) for i in range(meta.num_columns)}
    assert columns["ts"].is_stats_set and columns["ts"].physical_type == "INT64"


def test_files_are_clustered(store, feed):
    import pyarrow.parquet as pq

    store.ingest(feed("1.json", *[request(f"r{n}", api=f"api-{n * 7 % 5}", day=(DAY1, DAY2)[n % 2]) for n in range(400)]))
    for file in store.documents("request").inputFiles():
        apis = pq.ParquetFile(file.removeprefix("file://")).read(columns=["api"])["api"].to_pylist()
        assert apis == sorted(apis)


def test_an_absent_id_reads_no_rows(spark, store, feed):
    store.ingest(feed("1.json", *[request(f"r{n:04}") for n in range(0, 2000, 2)]))
    # Odd numbers are absent but inside the bounds of the statistics.
    for ids in (["r0501"], [f"r{n:04}" for n in range(501, 541, 2)]):
        docs = logs.pick_ids(store.documents("request"), ids)
        docs.collect()
        scan_node = docs._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert scan_node.metrics().apply("numOutputRows").value() == 0


@pytest.mark.parametrize("max_files", [1, 2, 1_000])
def test_a_stream_does_not_depend_on_its_batches(store, feed, tmp_path, max_files):
    for age, name in enumerate(("feed-9", "feed-10", "feed-1")):
        bad = "nonsense\n{}\n" if age == 1 else ""
        path = feed(name, request("r1", status=201 + age), bad, request(f"own-{age}"))
        os.utime(path, (1_000_000_000 + age, 1_000_000_000 + age))
    store.start_ingest(str(tmp_path / "feed"), str(tmp_path / "progress"), max_files=max_files).awaitTermination()
    assert statuses(store) == {(DAY1, "r1"): 203, **{(DAY1, f"own-{n}"): 200 for n in range(3)}}
    assert [r.reason for r in store.rejects().collect()] == ["no usable action"]


def test_lookup_by_frame_reads_payloads_of_the_days_found(spark, store, feed):
    days = [f"2017.05.{n:02}" for n in range(1, 29)]
    log = lambda i, day: action("log", i, day) + "\n" + json.dumps({"client-response": {"status": 201}}) + "\n"
    store.ingest(feed("1.json", *[request(f"r{n}", day) + log(f"r{n}", day) for n, day in enumerate(days)]))
    ids = spark.createDataFrame([("r3",), ("r20",)], "id string")
    found = store.find_requests(ids, strict=True)
    assert sorted((r.id, r.day, r.client_response.status) for r in found.collect()) == [("r20", days[20], 201), ("r3", days[3], 201)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    payloads = next(line for line in plan.splitlines() if "FileScan" in line and "client_response" in line)
    assert "array_contains" in payloads.partition("PartitionFilters")[2].partition("PushedFilters")[0]


def test_strict_lookups_fail_whatever_is_selected(spark, store, feed):
    check = action("health", "h1") + "\n" + json.dumps({"@timestamp": "2017-05-22T10:00:00Z", "api": "a"}) + "\n"
    store.ingest(feed("1.json", request("r1"), check))
    for find, known, field in ((store.find_requests, "r1", "uri"), (store.find_health, "h1", "timestamp")):
        assert find([known]).count() == 1
        frame = spark.createDataFrame([("nope",), (known,)], "id string")
        for ids in (["nope"], [known, "nope"], frame):
            for act in (lambda d: d.count(), lambda d, f=field: d.select(f).collect(), lambda d: d.collect()):
                with pytest.raises(Exception, match="has the id nope"):
                    act(find(ids))
            assert find(ids, strict=False).count() == (0 if ids == ["nope"] else 1)


def test_stream(store, feed, tmp_path):
    landing = str(tmp_path / "feed")
    feed("1.json", request("r1"), request("r2"))
    store.start_ingest(landing, str(tmp_path / "progress")).awaitTermination()
    assert statuses(store) == {(DAY1, "r1"): 200, (DAY1, "r2"): 200}
    feed("2.json", request("r2", status=500), request("r3", DAY2))
    store.start_ingest(landing, str(tmp_path / "progress")).awaitTermination()
    assert statuses(store) == {(DAY1, "r1"): 200, (DAY1, "r2"): 500, (DAY2, "r3"): 200}


def test_a_batch_is_neither_held_nor_sorted_for_its_merge(spark, store, feed, monkeypatch):
    """Only a type with a repeated id is put in order; the others go to their parts as they were parsed."""
    seen = {}

    def watched(docs, root, doc_type, shape):
        plan = docs._jdf.queryExecution().executedPlan().toString()
        seen[doc_type] = any(step in plan for step in ("Exchange", "Sort", "Window", "InMemoryTableScan")), {day: size for day, (size, _) in shape.items()}
        assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == 0
        tables.upsert(docs, root, doc_type, shape)

    monkeypatch.setattr(bulk, "upsert", watched)
    check = action("health", "h1") + '\n{"@timestamp":"2017-05-22T10:00:00Z","api":"a"}\n'
    repeated = request("r1", status=201)
    store.ingest(feed("one.json", request("r1"), check, *[repeated] * 50))
    assert [ordered for ordered, _ in seen.values()] == [False, False]
    assert seen["request"][1][DAY1] < 2 * len(repeated)  # an id that is repeated counts once
    assert statuses(store) == {(DAY1, "r1"): 201}
    assert [name for name in os.listdir(store.root) if name.startswith(bulk.BATCH)] == []


def test_a_compressed_feed(spark, store, tmp_path):
    records = [request(f"r{n}", end="\n").rstrip("\n") for n in range(50)]
    frame = spark.createDataFrame([(r,) for r in records], "value string").coalesce(1)
    frame.write.option("maxRecordsPerFile", 20).text(str(tmp_path / "packed"), compression="gzip")
    store.ingest(str(tmp_path / "packed"))
    assert statuses(store) == {(DAY1, f"r{n}"): 200 for n in range(50)}


def steps_of(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return {step for step in ("Exchange", "Join", "Sort", "Window", "InMemoryTableScan") if step in plan}


def test_a_changed_part_is_shuffled_once(spark, store, feed, monkeypatch):
    """Stored and new rows go to their part as they were read; which parts change is known by ids and hashes."""
    store.ingest(feed("1.json", *[request(f"r{n}") for n in range(20)]))
    seen, real = [], tables.write

    def watched(docs, path, *rest):
        seen.append((tables.STAGED in path, steps_of(docs)))
        assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == 0
        real(docs, path, *rest)

    monkeypatch.setattr(tables, "write", watched)
    store.ingest(feed("2.json", *[request(f"r{n}", status=404) for n in range(0, 30, 3)]))
    assert seen == [(True, set())]
    assert statuses(store) == {(DAY1, f"r{n}"): 404 if n % 3 == 0 else 200 for n in [*range(20), 21, 24, 27]}
    assert store.documents("request").count() == 23


def test_a_share_of_the_ids_tells_which_parts_change(store, feed, monkeypatch):
    """All ids are compared only in parts where the share has shown no change."""
    monkeypatch.setattr(tables, "LOOKED_AT_FIRST", 0, raising=False)
    monkeypatch.setattr(tables, "FIRST_LOOK", 8, raising=False)
    store.ingest(feed("1.json", *[request(f"r{n}", day) for n in range(400) for day in (DAY1, DAY2)]))
    files, seen = files_by_part(store), []

    def compared(stored, docs):
        """Documents per day that are joined with stored rows."""
        return {r.day: r["count"] for r in docs.join(stored.select("day").distinct(), "day").groupBy("day").count().collect()}

    for name in ("with_ids_of", "with_other_hashes"):
        real = getattr(tables, name)
        watched = lambda stored, docs, real=real: seen.append(compared(stored, docs)) or real(stored, docs)
        monkeypatch.setattr(tables, name, watched)
    # All of the first day changes, on the second one document is new; on a third all are.
    changed = [request(f"r{n}", status=404) for n in range(400)]
    store.ingest(feed("2.json", *changed, *[request(f"r{n}", DAY2) for n in range(401)], request("r1", "2017.05.24")))
    assert max(rows.get(DAY1, 0) for rows in seen) < 200  # shared out by hash: 50 of 400, about
    assert [rows for rows in seen if rows.get(DAY2) == 401]
    want = {(DAY1, f"r{n}"): 404 for n in range(400)} | {(DAY2, f"r{n}"): 200 for n in range(401)}
    assert statuses(store) == want | {("2017.05.24", "r1"): 200} and store.documents("request").count() == 802
    second = (f"day={DAY2}", "bucket=-1")
    assert files[second] < files_by_part(store)[second] and not files[(f"day={DAY1}", "bucket=-1")] & files_by_part(store)[(f"day={DAY1}", "bucket=-1")]


def test_one_change_that_the_share_misses(spark, store, feed, monkeypatch):
    """A part with a single changed row is rewritten, whether its id is of the share or not."""
    monkeypatch.setattr(tables, "LOOKED_AT_FIRST", 0, raising=False)
    monkeypatch.setattr(tables, "FIRST_LOOK", 1_000_000, raising=False)
    records = [request(f"r{n}") for n in range(40)]
    store.ingest(feed("1.json", *records))
    store.ingest(feed("2.json", *records[:39], request("r39", status=500), request("r40")))
    assert statuses(store) == {(DAY1, f"r{n}"): 500 if n == 39 else 200 for n in range(41)}
    assert store.documents("request").count() == 41


def test_ids_that_come_twice_are_told_apart_in_their_part(store, feed, monkeypatch):
    seen, real = [], tables.write
    monkeypatch.setattr(tables, "write", lambda docs, *rest: seen.append(steps_of(docs)) or real(docs, *rest))
    records = [request(f"r{n}", status=200 + turn) for turn in range(3) for n in range(10)]
    store.ingest(feed("1.json", *records, request("r11")))
    assert seen == [set()]
    want = {(DAY1, f"r{n}"): 202 for n in range(10)} | {(DAY1, "r11"): 200}
    assert statuses(store) == want and store.documents("request").count() == 11
    files = sorted(store.documents("request").inputFiles())
    store.ingest(feed("1.json", *records, request("r11")))
    assert statuses(store) == want and sorted(store.documents("request").inputFiles()) == files


def test_a_change_that_the_hash_of_a_row_does_not_tell(spark, store, feed):
    """Nulls don't count in it, so a value that moves to another column has the same."""
    store.ingest(feed("1.json", request("r1", **{"request-content-length": 7})))
    typed = bulk.typed_rows(bulk.parse_bulk(bulk.read_bulk(spark, feed("2.json", request("r1", **{"response-content-length": 7})))), "request")
    stored, docs = tables.scan_parts(spark, store.root, "request"), typed.withColumn("bucket", F.lit(-1))
    assert tables.with_other_hashes(stored, docs).count() == 0
    assert tables.with_other_texts(stored, docs).count() == 1
    store.ingest(str(feed("2.json", request("r1", **{"response-content-length": 7}))))
    row = store.documents("request").first()
    assert (row.request_content_length, row.response_content_length) == (None, 7)


def test_parsed_documents_are_copied_twice_at_most(spark, feed):
    """Each projection after the one that parses copies the wide rows once more."""
    parsed = bulk.parse_bulk(bulk.read_bulk(spark, feed("1.json", request("r1"))))
    plan = parsed._jdf.queryExecution().executedPlan().toString().split("\n")
    steps = [line.strip("+- :*()0123456789") for line in plan]
    parsing = max(n for n, step in enumerate(steps) if step.startswith("Project") and "_unreadable,StringType" in step)
    assert sum(step.startswith("Project") for step in steps[:parsing]) <= 2


def test_a_staged_batch_is_written_plainly(store, feed, monkeypatch):
    """Its files live for the length of the call; dictionaries and statistics would be made for nothing."""
    found, real = [], bulk.batch_shapes

    def watched(staged):
        for file in staged.inputFiles():
            group = pq.ParquetFile(file.removeprefix("file://")).metadata.row_group(0)
            columns = [group.column(n) for n in range(group.num_columns)]
            found.extend(c.has_dictionary_page or (c.statistics is not None and c.statistics.has_min_max) for c in columns)
        return real(staged)

    monkeypatch.setattr(bulk, "batch_shapes", watched)
    store.ingest(feed("1.json", *[request(f"r{n % 7}", status=200 + n) for n in range(70)]))
    assert found and not any(found)
    assert statuses(store) == {(DAY1, f"r{n}"): 263 + n for n in range(7)}


def test_actions_as_producers_write_them(spark):
    lines = {
        '{"index":{"_index":"a","_type":"request","_id":"r1"}}': ("a", "request", "r1"),
        '{"index":{"_index":"a","_type":"request","_id":"r1"}} \r': ("a", "request", "r1"),
        '{"index":{"_index":"","_type":"request","_id":""}}': ("", "request", ""),
        '{"index":{"_id":"r1","_type":"request","_index":"a"}}': ("a", "request", "r1"),
        r'{"index":{"_index":"a","_type":"request","_id":"r\"1"}}': ("a", "request", 'r"1'),
        r'{"index":{"_index":"a","_type":"request","_id":"r\\"}}': ("a", "request", "r\\"),
        '{"index":{"_index":"a","_type":"request","_id":"r1","x":"y"}}': ("a", "request", "r1"),
    }
    frame = spark.createDataFrame([(line,) for line in lines], "line string")
    found = frame.select("line", bulk.action_of(F.col("line"), F.split("line", '"')).alias("action"))
    assert {r.line: tuple(r.action) for r in found.collect()} == lines
    stamps = spark.createDataFrame([("2017-05-22T18:10:11Z\n",), ("2017-05-22T18:10:11",), ("2017-05-22T18:10:11.5+0100",)], "t string")
    assert [to_millis(r[0]) % 60_000 for r in stamps.select(parse_timestamp(F.col("t"))).collect()] == [11_000, 11_000, 11_500]

from __future__ import annotations

import gzip
import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan_text
from jobsignals.operators.calls import CallPolicy
from jobsignals.plans.enrichment import plan_rounds, run_extraction
from jobsignals.schemas import EXTRACT, RAW_POSTING, SEEDS, required_columns
from jobsignals.session import scratch_path
from jobsignals.sources.export import (
    export_and_reconcile,
    export_tables,
    flat_sample,
    load_copy,
    match_columns,
    nested_to_variant,
    reconcile,
    without_zone,
    write_flat_sample,
)
from jobsignals.sources.landing import ingest, ingest_summary, land_jsonl, landed_part, landing_key, read_jsonl, stamp
from jobsignals.sources.seeds import bundled_seed, read_seed
from jobsignals.sources.tables import (
    append_snapshot,
    inventory,
    drop_partitions,
    inventory_with_size,
    materialise,
    one_of,
    replace_partitions,
    row_count,
    upsert_table,
)
from jobsignals.streaming.landing import landed_stream, load_new_files
from postings_fixture import DAY, NEXT_DAY, extract, extract_frame, posting, raw_frame, raw_rows


def test_landing_keys():
    day = date(2026, 5, 6)
    assert landing_key("postings", day, "Melbourne") == "postings/snapshot_date=2026-05-06/melbourne.jsonl.gz"
    assert landing_key("postings", day, "Brisbane Region") == "postings/snapshot_date=2026-05-06/brisbane-region.jsonl.gz"
    assert landing_key("p", date(2026, 1, 1), "Sydney", "json") == "p/snapshot_date=2026-01-01/sydney.json"


def test_landing_round_trip_and_relanding_one_city(spark, tmp_path):
    path = str(tmp_path / "landing")
    raw = raw_frame(spark)
    land_jsonl(raw, path)
    assert list(Path(path).glob("snapshot_date=2026-05-06/city_slug=brisbane/*.gz"))
    back = read_jsonl(spark, path)
    assert back.columns == RAW_POSTING.names
    assert sorted(map(str, back.collect())) == sorted(map(str, raw.select(*RAW_POSTING.names).collect()))
    again = raw.where("source_city = 'Brisbane'").withColumn("title", F.lit("new"))
    land_jsonl(again, path)
    land_jsonl(again, path)
    back = read_jsonl(spark, path)
    assert back.count() == raw.count()
    assert {r.source_city for r in back.where("title = 'new'").collect()} == {"Brisbane"}


def write_lines(path, *lines):
    path.mkdir(parents=True)
    with gzip.open(path / "x.jsonl.gz", "wt", encoding="utf-8") as out:
        out.writelines(line + "\n" for line in lines)
    return str(path)


def line(**more):
    row = {"snapshot_date": "2026-05-06", "ingested_at": "2026-05-06T10:00:00+00:00", "source_city": "Sydney", "id": "1", **more}
    return json.dumps(row)


def test_unknown_fields_are_ignored_and_malformed_lines_fail(spark, tmp_path):
    good = write_lines(tmp_path / "good", line(title="T", extra={"x": 1}, company={"display_name": "A", "y": 2}))
    row = read_jsonl(spark, good).first()
    assert row.title == "T" and row.company.display_name == "A" and row.location is None
    assert row.ingested_at == datetime(2026, 5, 6, 10, 0, 0)
    bad = write_lines(tmp_path / "bad", line(), '{"id": ')
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        read_jsonl(spark, bad).collect()


def test_required_columns_are_enforced(spark, tmp_path):
    assert required_columns(RAW_POSTING) == ["snapshot_date", "ingested_at", "source_city", "id"]
    path = write_lines(tmp_path / "null", line(), line(id=None))
    with pytest.raises(Exception, match="required column id is NULL"):
        read_jsonl(spark, path).collect()
    assert read_jsonl(spark, path, check=False).count() == 2


def test_stamp(spark):
    at = datetime(2026, 5, 6, 1, 2, 3)
    row = stamp(spark.range(1), DAY, at, "Brisbane Region").first()
    assert (row.snapshot_date, row.ingested_at, row.source_city) == (DAY, at, "Brisbane Region")


def test_append_and_replace(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw = raw_frame(spark)
    append_snapshot(raw, path)
    append_snapshot(raw.where(F.col("snapshot_date") == NEXT_DAY), path)
    table = spark.read.schema(RAW_POSTING).parquet(path)
    assert table.count() == len(raw_rows()) + 1
    replace_partitions(raw.where(F.col("snapshot_date") == NEXT_DAY), path)
    assert spark.read.schema(RAW_POSTING).parquet(path).count() == len(raw_rows())
    pruned = plan_text(table.where(F.col("snapshot_date") == NEXT_DAY))
    assert "PartitionFilters: [isnotnull(snapshot_date" in pruned


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "extracts")
    upsert_table(spark, path, extract_frame(spark))
    before = {p.name: p.stat().st_mtime_ns for p in Path(path).glob("snapshot_date=2026-05-07/*.parquet")}
    batch = extract_frame(spark, [extract("7", skills=["Go"]), extract("new"), extract("x", date(2026, 6, 1))])
    for _ in range(2):  # the same batch twice changes nothing more
        upsert_table(spark, path, batch)
        rows = {(r.job_id, r.snapshot_date): r for r in spark.read.schema(EXTRACT).parquet(path).collect()}
        assert len(rows) == extract_frame(spark).count() + 2
        assert rows["7", DAY].extraction_status == "ok" and rows["7", DAY].required_skills == ["Go"]
        assert rows["7", DAY].error_message is None and rows["1", DAY].required_skills == ["Python", "SQL"]
    after = {p.name: p.stat().st_mtime_ns for p in Path(path).glob("snapshot_date=2026-05-07/*.parquet")}
    assert before == after  # an untouched day keeps its files
    with pytest.raises(ValueError, match="several rows for one key"):
        upsert_table(spark, path, extract_frame(spark, [extract("1"), extract("1")]))


def test_upsert_calls_the_extractor_once_per_row(spark, tmp_path):
    from jobsignals.operators.extraction import extract_signals

    calls = tmp_path / "calls"
    calls.mkdir()

    def extractor(text):
        import uuid

        (calls / uuid.uuid4().hex).write_text(text)
        return {}

    pending = spark.createDataFrame(
        [(str(i), DAY, f"text {i}") for i in range(5)], "job_id string, snapshot_date date, description_text string"
    )
    records = extract_signals(pending, extractor, "m", datetime(2026, 5, 6))
    upsert_table(spark, str(tmp_path / "t"), records)
    assert len(list(calls.iterdir())) == 5


def test_seeds_have_pinned_types(spark, tmp_path):
    for name, schema in SEEDS.items():
        df = bundled_seed(spark, name)
        assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in schema.fields]
        assert "LocalTableScan" in plan_text(df)
    assert [bundled_seed(spark, n).count() for n in SEEDS] == [10, 8, 14, 11]
    csv = tmp_path / "lists.csv"
    csv.write_text('anzsco_code,occupation_name,list_name,effective_date\n#1,"he said ""hi"", ok\nthere ",,2024-07-01\n')
    row = read_seed(spark, "occupation_lists", str(csv)).first()
    assert (row.anzsco_code, row.occupation_name) == ("#1", 'he said "hi", ok\nthere ')
    assert (row.list_name, row.effective_date) == (None, date(2024, 7, 1))
    csv.write_text("anzsco_code,occupation_name,list_name,effective_date\n1,A,B,never\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|parse"):
        read_seed(spark, "occupation_lists", str(csv)).collect()


def test_materialise(spark, tmp_path):
    df = raw_frame(spark).select("id", "snapshot_date", "source_city")
    stored = materialise(
        df, "t", path=str(tmp_path), partition_by=["snapshot_date"], cluster_by=["source_city"], comments={"id": "job id"}
    )
    assert stored.count() == df.count() and stored.columns == ["id", "source_city", "snapshot_date"]
    assert materialise(stored, "some_view", kind="view").count() == df.count()
    assert spark.table("some_view").count() == df.count()


def test_materialise_in_the_catalog(spark):
    df = raw_frame(spark).select("id", "snapshot_date", "source_city")
    stored = materialise(
        df, "postings", layer="staging_layer", partition_by=["snapshot_date"], comments={"id": "job id"}
    )
    assert stored.count() == df.count()
    described = {r.col_name: r.comment for r in spark.sql("DESCRIBE staging_layer.postings").collect()}
    assert described["id"] == "job id"
    spark.sql("DROP TABLE staging_layer.postings")


def test_export_and_reconcile(spark, tmp_path):
    tables = {"raw": raw_frame(spark), "extracts": extract_frame(spark)}
    report = export_and_reconcile(spark, tables, str(tmp_path))
    assert {(r.table_name, r.source_rows, r.ok) for r in report.collect()} == {
        ("raw", len(raw_rows()), True),
        ("extracts", extract_frame(spark).count(), True),
    }
    copy = spark.read.parquet(str(tmp_path / "raw"))
    assert dict(copy.dtypes)["created"] == "timestamp_ntz" and dict(copy.dtypes)["location"].startswith("struct")
    export_tables({"raw": tables["raw"].limit(3)}, str(tmp_path))
    assert reconcile(spark, {"raw": len(raw_rows())}, str(tmp_path)).first().ok is False
    assert dict(nested_to_variant(without_zone(tables["raw"])).dtypes)["location"] == "variant"
    upper = copy.toDF(*[c.upper() for c in copy.columns]).drop("ADREF")
    assert match_columns(upper, RAW_POSTING).columns == RAW_POSTING.names


def test_flat_sample(spark, tmp_path):
    rows = {r.id: r for r in flat_sample(raw_frame(spark)).collect()}
    assert rows["7"].description_snippet == "<p>Hi <b>there</b></p>\t tester"
    assert rows["3"].company is None and rows["3"].description_snippet == "" and rows["5"].state is None
    write_flat_sample(raw_frame(spark), str(tmp_path / "csv"))
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "csv"))
    assert back.count() == len(raw_rows()) and back.columns[-1] == "description_snippet"


def test_counts_and_inventory(spark, tmp_path):
    raw = raw_frame(spark)
    append_snapshot(raw, str(tmp_path / "raw"))
    stored = spark.read.schema(RAW_POSTING).parquet(str(tmp_path / "raw"))
    assert row_count(stored).first().row_count == len(raw_rows())
    assert {tuple(r) for r in inventory({"a": stored, "b": stored.limit(0)}).collect()} == {("a", len(raw_rows())), ("b", 0)}
    sized = inventory_with_size(spark, {"a": str(tmp_path / "raw")}).first()
    size = sum(p.stat().st_size for p in (tmp_path / "raw").rglob("*.parquet"))
    assert sized.row_count == len(raw_rows()) and sized.size_bytes == size and sized.size_mb == round(size / 1024 / 1024, 2)
    summary = {r.source_city: r for r in ingest_summary(raw, raw.where("source_city <> 'Brisbane'")).collect()}
    assert summary["Brisbane"].loaded_rows == 0 and not summary["Brisbane"].ok and summary["Sydney"].ok


def test_stream_loads_each_file_once(spark, tmp_path):
    landing, table, state = (str(tmp_path / x) for x in ("landing", "table", "state"))
    raw = raw_frame(spark)
    expected = 0
    for city in ("Sydney", "Melbourne", None, "Brisbane"):
        part = raw.where(F.col("source_city") == city)
        if city:
            land_jsonl(part, landing)
            expected += part.count()
        load_new_files(landed_stream(spark, landing), landing, table, state).awaitTermination()
        assert spark.read.schema(RAW_POSTING).parquet(table).count() == expected
    again = raw.where("source_city = 'Sydney'").withColumn("title", F.lit("again"))
    land_jsonl(again, landing)
    load_new_files(landed_stream(spark, landing), landing, table, state).awaitTermination()
    rows = spark.read.schema(RAW_POSTING).parquet(table)
    assert rows.count() == expected
    assert {r.title for r in rows.where("source_city = 'Sydney'").collect()} == {"again"}


def test_landed_records_hold_their_day(spark, tmp_path):
    land_jsonl(raw_frame(spark), str(tmp_path))
    for file in tmp_path.rglob("*.gz"):
        day = file.parent.parent.name.removeprefix("snapshot_date=")
        assert all(json.loads(line)["snapshot_date"] == day for line in gzip.open(file, "rt"))
    one_day = read_jsonl(spark, str(tmp_path)).where(F.col("snapshot_date") == F.lit(DAY))
    plan = spark._jvm.PythonSQLUtils.explainString(one_day._jdf.queryExecution(), "formatted")
    filters = next(line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    assert "snapshot_date" in filters and DAY.isoformat() in filters


def test_replacing_days_with_nothing(spark, tmp_path):
    path, raw = str(tmp_path / "t"), raw_frame(spark)
    replace_partitions(raw, path)
    replace_partitions(raw.where(F.lit(False)), path, covered=[DAY])
    left = spark.read.schema(RAW_POSTING).parquet(path)
    assert left.where(F.col("snapshot_date") == F.lit(DAY)).count() == 0
    assert left.count() == raw.where(F.col("snapshot_date") != F.lit(DAY)).count()
    drop_partitions(spark, path, "snapshot_date", [NEXT_DAY, date(1999, 1, 1)])
    assert left.sparkSession.read.schema(RAW_POSTING).parquet(path).count() == raw.where(~F.col("snapshot_date").isin(DAY, NEXT_DAY)).count()


def test_upserts_leave_no_staging_copies(spark, tmp_path):
    base = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "jobsignals"
    before = set(base.glob("batch-*")) | set(base.glob("merged-*"))
    for _ in range(3):
        upsert_table(spark, str(tmp_path / "extracts"), extract_frame(spark))
    assert set(base.glob("batch-*")) | set(base.glob("merged-*")) == before


def test_extraction_loop(spark, tmp_path):
    path = str(tmp_path / "extracts")
    calls = tmp_path / "calls"
    calls.mkdir()

    def extractor(text):
        import uuid

        from pyspark import TaskContext

        (calls / f"{TaskContext.get().partitionId()}-{uuid.uuid4().hex}").write_text(text)
        if text.endswith("7"):
            raise ValueError("no answer")
        return {"years_experience": 2}

    staged = spark.createDataFrame([(str(i), DAY, f"a text long enough {i}") for i in range(60)], "job_id string, snapshot_date date, description_text string")
    counts = run_extraction(staged, extractor, "m", datetime(2026, 5, 6), path).first()
    assert (counts.rows, counts.ok_rows, counts.error_rows) == (60, 54, 6)
    assert len(list(calls.iterdir())) == 60 and len({f.name.split("-")[0] for f in calls.iterdir()}) > 1
    again = run_extraction(staged, extractor, "m", datetime(2026, 5, 7), path).first()
    assert (again.rows, again.error_rows) == (6, 6)  # failed rows are tried again, others are not
    assert spark.read.schema(EXTRACT).parquet(path).count() == 60


def test_copies_load_into_the_target_schema(spark, tmp_path):
    export_and_reconcile(spark, {"raw": raw_frame(spark)}, str(tmp_path))
    target = T.StructType([T.StructField("ID", T.StringType()), T.StructField("Company", T.VariantType()), T.StructField("more", T.LongType())])
    loaded = load_copy(spark, str(tmp_path), "raw", target)
    assert loaded.columns == ["ID", "Company", "more"] and loaded.count() == len(raw_rows())
    names = {r.n for r in loaded.select(F.try_variant_get("Company", "$.display_name", "string").alias("n")).collect()}
    assert names == {r.n for r in raw_frame(spark).select(F.col("company.display_name").alias("n")).collect()}


def test_scratch_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    if base:
        assert path.startswith(base.rstrip("/"))


def scans(df):
    """Partitions and files that the scans of ``df`` read when it is collected."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    found = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        metrics = leaf.metrics()
        if metrics.contains("numFiles"):
            found.append((metrics.get("numPartitions").get().value(), metrics.get("numFiles").get().value()))
    return found


def damage(folder):
    """Files that no reader can open: proof that nothing reads them."""
    files = [f for f in Path(folder).rglob("*") if f.suffix in (".parquet", ".gz")]
    assert files
    for file in files:
        file.write_bytes(b"damaged")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)


def days_of(n):
    return [date(2026, 1, 1 + i) for i in range(n)]


def test_upsert_reads_the_days_of_the_batch_only(spark, tmp_path):
    path = str(tmp_path / "extracts")
    upsert_table(spark, path, extract_frame(spark, [extract(str(i), day) for day in days_of(12) for i in range(3)]))
    batch = extract_frame(spark, [extract("1", days_of(12)[4], skills=["Go"]), extract("new", days_of(12)[7]), extract("x", date(2026, 3, 1))])
    assert scans(spark.read.schema(EXTRACT).parquet(path).where(one_of("snapshot_date", [days_of(12)[4], days_of(12)[7], date(2026, 3, 1)]))) == [(2, 2)]
    for day in set(days_of(12)) - {days_of(12)[4], days_of(12)[7]}:
        damage(f"{path}/snapshot_date={day}")
    upsert_table(spark, path, batch)
    rows = spark.read.schema(EXTRACT).parquet(path).where(F.col("snapshot_date").isin(days_of(12)[4], days_of(12)[7], date(2026, 3, 1)))
    assert rows.count() == 8 and rows.where("required_skills[0] = 'Go'").count() == 1


def test_a_refused_upsert_leaves_no_copies(spark, tmp_path):
    base = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "jobsignals"
    before = set(base.glob("batch-*")) | set(base.glob("merged-*"))
    path = str(tmp_path / "extracts")
    upsert_table(spark, path, extract_frame(spark, [extract("1", DAY)]))
    with pytest.raises(ValueError, match="several rows"):
        upsert_table(spark, path, extract_frame(spark, [extract("1", DAY), extract("1", DAY)]))
    damage(f"{path}/snapshot_date={DAY}")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        upsert_table(spark, path, extract_frame(spark, [extract("2", DAY)]))
    assert set(base.glob("batch-*")) | set(base.glob("merged-*")) == before


def test_landed_folders_are_pruned(spark, tmp_path):
    path, raw = str(tmp_path / "landing"), raw_frame(spark)
    land_jsonl(raw, path)
    land_jsonl(raw.withColumn("snapshot_date", F.lit(date(2026, 7, 7))), path)
    wanted = [(DAY, "sydney"), (date(2026, 7, 7), "brisbane"), (date(1999, 1, 1), "sydney")]
    part = landed_part(spark, path, wanted)
    assert [n for n, _ in scans(part)] == [2]
    expected = raw.where((F.col("snapshot_date") == F.lit(DAY)) & (F.col("source_city") == "Sydney")).count() + raw.where("source_city = 'Brisbane'").count()
    assert part.count() == expected and part.columns == RAW_POSTING.names
    assert landed_part(spark, path, []).count() == 0


def test_a_stream_batch_opens_changed_folders_only(spark, tmp_path):
    landing, table, state = (str(tmp_path / x) for x in ("landing", "table", "state"))
    raw = raw_frame(spark)
    land_jsonl(raw, landing)
    load_new_files(landed_stream(spark, landing), landing, table, state).awaitTermination()
    damage(f"{landing}/snapshot_date={DAY}/city_slug=brisbane")
    again = raw.where("source_city = 'Sydney'").withColumn("title", F.lit("again"))
    land_jsonl(again, landing)
    load_new_files(landed_stream(spark, landing), landing, table, state).awaitTermination()
    rows = spark.read.schema(RAW_POSTING).parquet(table)
    assert rows.count() == raw.count() and {r.title for r in rows.where("source_city = 'Sydney'").collect()} == {"again"}


def test_ingest_counts_at_the_table(spark, tmp_path, monkeypatch):
    import jobsignals.sources.landing as landing_module

    raw = raw_frame(spark)
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")
    cities = {r.source_city: r.n for r in raw.groupBy("source_city").agg(F.count("*").alias("n")).collect()}
    for replace in (True, False, True):
        report = {r.source_city: r for r in ingest(spark, raw, landing, table, replace).collect()}
        assert {c: r.fetched_rows for c, r in report.items()} == {c: r.loaded_rows for c, r in report.items()} == cities
        assert all(r.ok for r in report.values())
    assert spark.read.schema(RAW_POSTING).parquet(table).count() == raw.count()

    def loses_a_day(df, path):
        append_snapshot(df, path)
        drop_partitions(spark, path, "snapshot_date", [DAY])

    monkeypatch.setattr(landing_module, "append_snapshot", loses_a_day)
    report = ingest(spark, raw.withColumn("source_city", F.lit("Perth")), landing, str(tmp_path / "other"))
    assert [(r.ok, r.loaded_rows < r.fetched_rows) for r in report.collect()] == [(False, True)]


def test_ingest_works_the_batch_out_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def fetch(rows):
        for row in rows:
            seen.add(len(row))
            yield row

    raw = raw_frame(spark)
    ingest(spark, raw.mapInPandas(fetch, raw.schema), str(tmp_path / "landing"), str(tmp_path / "table"))
    assert seen.value == raw.count()


def test_replacing_covered_days_works_rows_out_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def rows_of(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    raw = raw_frame(spark)
    replace_partitions(raw, str(tmp_path))
    newer = raw.where(F.col("snapshot_date") == F.lit(DAY))
    replace_partitions(newer.mapInPandas(rows_of, raw.schema), str(tmp_path), covered=[DAY, NEXT_DAY])
    assert seen.value == newer.count() == spark.read.schema(RAW_POSTING).parquet(str(tmp_path)).count()


def test_rounds_are_committed_one_by_one(spark, tmp_path):
    path, calls, fixed = str(tmp_path / "extracts"), tmp_path / "calls", tmp_path / "fixed"
    calls.mkdir()

    def extractor(text):
        import uuid

        (calls / uuid.uuid4().hex).write_text(text)
        if "day 2" in text and not fixed.exists():
            raise SystemExit("the process is gone")
        return {"years_experience": 1}

    days = days_of(4)
    rows = [(f"{d}-{i}", days[d], f"posting {i} of day {d}, long enough") for d in range(4) for i in range(20)]
    staged = spark.createDataFrame(rows, "job_id string, snapshot_date date, description_text string")
    more = {"policy": CallPolicy(in_flight=2), "round_rows": 15}
    with pytest.raises(Exception):  # noqa: B017 - whatever Spark makes of a dead worker
        run_extraction(staged, extractor, "m", datetime(2026, 5, 6), path, **more)
    done = spark.read.schema(EXTRACT).parquet(path)
    assert {r.snapshot_date for r in done.collect()} == {days[3]} and done.count() == 20
    for file in calls.iterdir():
        file.unlink()
    fixed.touch()
    counts = run_extraction(staged, extractor, "m", datetime(2026, 5, 7), path, **more).first()
    assert (counts.rows, counts.ok_rows) == (60, 60) and len(list(calls.iterdir())) == 60
    assert spark.read.schema(EXTRACT).parquet(path).count() == 80
    assert not list((Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "jobsignals").glob("pending-*"))


def test_rounds_hold_every_row_once():
    days = days_of(6)
    per_day = dict(zip(days, [5, 100, 3, 4, 30, 1]))
    rounds = plan_rounds(per_day, 10)
    assert [d for d, _, _ in rounds if d[0] == days[1]] == [[days[1]]] * 10
    assert sorted(p for d, p, n in rounds if d[0] == days[4] and n == 3) == [0, 1, 2]
    assert {d for ds, _, _ in rounds for d in ds} == set(days)
    assert all(sum(per_day[d] for d in ds) <= 10 for ds, _, parts in rounds if parts == 1)
    assert plan_rounds({}, 10) == []


def test_landed_files_are_loaded_without_a_shuffle(spark, tmp_path, monkeypatch):
    """What comes from files of one day each goes to the table from the tasks that read it."""
    from jobsignals.sources import landing, tables

    plans = []
    layout = tables._layout

    def seen(*args):
        plans.append(plan_text(layout(*args)))
        return layout(*args)

    monkeypatch.setattr(tables, "_layout", seen)
    for replace in (True, False):
        landing.ingest(spark, raw_frame(spark), str(tmp_path / "landing"), str(tmp_path / "table"), replace)
    assert len(plans) == 2 and not any("Exchange" in p for p in plans)
    assert spark.read.schema(RAW_POSTING).parquet(str(tmp_path / "table")).count() == 2 * len(raw_rows())


def test_the_flat_sample_can_be_compressed(spark, tmp_path):
    write_flat_sample(raw_frame(spark), str(tmp_path / "csv"), compression="gzip")
    assert list((tmp_path / "csv").glob("*.csv.gz")) and not list((tmp_path / "csv").glob("*.csv"))


def test_a_day_of_many_rounds_is_rewritten_once(spark, tmp_path, monkeypatch):
    from jobsignals.plans import enrichment

    path, calls, fixed = str(tmp_path / "extracts"), tmp_path / "calls", tmp_path / "fixed"
    calls.mkdir()
    merges = []

    def merged(*args):
        merges.append(args)
        return upsert_table(*args)

    monkeypatch.setattr(enrichment, "upsert_table", merged)

    def extractor(text):
        import uuid

        (calls / uuid.uuid4().hex).write_text(text)
        if "text 33," in text and not fixed.exists():
            raise SystemExit("the process is gone")
        return {"years_experience": 1}

    staged = spark.createDataFrame([(str(i), DAY, f"text {i}, long enough for a call") for i in range(60)], "job_id string, snapshot_date date, description_text string")
    more = {"policy": CallPolicy(in_flight=2), "round_rows": 10}
    with pytest.raises(Exception):  # noqa: B017 - whatever Spark makes of a dead worker
        run_extraction(staged, extractor, "m", datetime(2026, 5, 6), path, **more)
    done = spark.read.schema(EXTRACT).parquet(path).count()
    for file in calls.iterdir():
        file.unlink()
    fixed.touch()
    counts = run_extraction(staged, extractor, "m", datetime(2026, 5, 7), path, **more).first()
    assert counts.rows == 60 - done == len(list(calls.iterdir()))
    assert spark.read.schema(EXTRACT).parquet(path).count() == 60 and len(merges) <= 2
    assert not (Path(path) / "_answered" / "rows").exists()

    merges.clear()
    run_extraction(staged, extractor, "m", datetime(2026, 5, 7), str(tmp_path / "fresh"), **more)
    assert len(merges) == 1
    assert spark.read.schema(EXTRACT).parquet(str(tmp_path / "fresh")).count() == 60


def test_a_stored_batch_lands_in_rounds(spark, tmp_path, monkeypatch):
    """No write shuffles more rows than a round has; what lands is the same, also where one folder
    takes several rounds, where its rows are all alike, and where folders have no name."""
    from jobsignals.sources import landing

    sizes = []
    write = landing._write_lines

    def seen(lines, *args):
        sizes.append(lines.count())
        write(lines, *args)

    monkeypatch.setattr(landing, "_write_lines", seen)
    monkeypatch.setattr(landing, "ROUND_ROWS", 20)
    days = [date(2026, 5, d) for d in range(1, 5)]
    cities = ["Sydney", "Brisbane Region", "", None]
    rows = [posting(str(i), cities[i % 4], days[i % 3]) for i in range(60)]
    rows += [posting(str(i), "Perth", days[3]) for i in range(70)]
    rows += [posting("1", "Perth", days[0], "alike")] * 45
    path = str(tmp_path / "landing")
    lands = lambda: sorted(str(r) for r in read_jsonl(spark, path, check=False).collect())
    for title in ("first", "again"):  # the second replaces every folder
        stored = raw_frame(spark, rows).withColumn("title", F.concat(F.lit(title), "title"))
        landing.store_batch(stored, str(tmp_path / title))
        stored = spark.read.schema(stored.schema).parquet(str(tmp_path / title))
        sizes.clear()
        landing.land_jsonl(stored, path, folders=landing.rows_per_folder(stored))
        assert len(sizes) >= 9 and sum(sizes) == len(rows) and sorted(sizes)[-2] <= 30
        assert lands() == sorted(str(r) for r in stored.select(*RAW_POSTING.names).collect())
    city = stored.where("source_city = 'Sydney'").withColumn("title", F.lit("new"))
    landing.land_jsonl(city, path, folders=landing.rows_per_folder(city))
    expected = stored.withColumn("title", F.when(F.col("source_city") == "Sydney", F.lit("new")).otherwise(F.col("title")))
    assert lands() == sorted(str(r) for r in expected.select(*RAW_POSTING.names).collect())


def test_lines_of_a_title_stand_together(spark, tmp_path):
    rows = [posting(str(i), title=f"title {i * 7 % 10}") for i in range(100)]
    land_jsonl(raw_frame(spark, rows).repartition(4), str(tmp_path))
    files = list(tmp_path.rglob("*.gz"))
    for file in files:
        titles = [json.loads(line)["title"] for line in gzip.open(file, "rt")]
        assert len([a for a, b in zip(titles, titles[1:]) if a != b]) == len(set(titles)) - 1
    assert files


@pytest.mark.parametrize("key", ["land_jsonl", "reland_city", "ingest"])
def test_landing_queries_work_in_rounds(spark, monkeypatch, key):
    """Neither the join of the raw postings nor a landing handles all rows at once, and nothing of the
    fetched copy stays; the rows are the same."""
    from jobsignals.lens import all_queries, postings
    from jobsignals.sources import landing

    small, sizes = "/root/testdata/sf0.001", []
    run = lambda: sorted(map(str, all_queries()[key](spark, small).collect()))
    expected, copies = run(), set(Path(scratch_path(spark, "x")).parent.glob("raw-*"))
    write, store = landing._write_lines, landing.store_batch

    def written(lines, *args):
        sizes.append(lines.count())
        write(lines, *args)

    def stored(batch, path):
        sizes.append(batch.count())
        store(batch, path)

    monkeypatch.setattr(landing, "_write_lines", written)
    monkeypatch.setattr("jobsignals.lens.storage.store_batch", stored)
    for module in (postings, landing):
        monkeypatch.setattr(module, "ROUND_ROWS", 2500)
    assert run() == expected
    assert len(sizes) >= 6 and max(sizes) <= 2800
    assert set(Path(scratch_path(spark, "x")).parent.glob("raw-*")) == copies

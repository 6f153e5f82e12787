"""Sources and sinks: strict NDJSON, collections, exports, target table, snapshots."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shoplens.config import JobConfig
from shoplens.plans.registry import fixture_matrix
from shoplens.schemas import COLLECTION_FILES, MATRIX_COLUMNS
from shoplens.sinks import export, matrix as msink, snapshot
from shop_fixtures import documents
from shoplens.sources import ndjson, tables


def _write(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_strict_ndjson_skips_blank_lines_and_fails_on_bad_json(spark, tmp_dir):
    good = os.path.join(tmp_dir, "customers.jsonl")
    _write(good, ['{"customer_id": "c1", "email": "ä@b.ru"}', "", "   ",
                  '{"customer_id": "c2", "is_loyalty_member": true}', '{"customer_id": "c3", "is_loyalty_member": "yes"}'])
    df = ndjson.read_ndjson(spark, good, "customer_id STRING, email STRING, is_loyalty_member BOOLEAN")
    assert sorted((r.customer_id, r.is_loyalty_member) for r in df.collect()) == [("c1", None), ("c2", True), ("c3", None)]
    ndjson.validate_ndjson(spark, good)  # a value of another type is not a syntax error
    bad = os.path.join(tmp_dir, "bad.jsonl")
    _write(bad, ['{"customer_id": "c1"}', "{bad"])
    with pytest.raises(Exception, match="Invalid JSON"):
        ndjson.read_ndjson(spark, bad, "customer_id STRING").collect()


def test_collections_missing_file_is_an_error(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        ndjson.read_collections(spark, tmp_dir)
    for name, fname in COLLECTION_FILES.items():
        _write(os.path.join(tmp_dir, fname), ["{}"])
    dfs = ndjson.read_collections(spark, tmp_dir)
    assert set(dfs) == set(COLLECTION_FILES) and "document" in dfs["stores"].columns


def test_ndjson_round_trip_keeps_nested_and_non_ascii(spark, tmp_dir):
    docs = documents.customer_documents(spark, SF_SMALL)
    out = os.path.join(tmp_dir, "customers_json")
    export.write_ndjson(docs, out)
    back = spark.read.schema(docs.schema).json(out)
    assert back.count() == docs.count()
    assert back.exceptAll(docs).count() == 0


def test_messages_keep_null_fields(spark):
    df = spark.createDataFrame([("c1", None)], "customer_id string, email string")
    v = export.to_messages(df, "customers").first()
    assert v.topic == "retail.customers.l0" and v.value == '{"customer_id":"c1","email":null}'


def test_csv_export_monthly_file(spark, tmp_dir):
    m = fixture_matrix(spark, SF_SMALL)
    path = export.export_csv(m, tmp_dir, 2026, 2, single_file=True)
    assert path.endswith("analytic_result_2026_02.csv") and os.path.isfile(path)
    many = export.export_csv(m, tmp_dir, 2026, 2)
    assert spark.read.option("header", True).csv(many).count() == m.count()
    back = spark.read.option("header", True).csv(path)
    assert back.columns == list(MATRIX_COLUMNS) and back.count() == m.count()


def test_matrix_sink_append_truncate_and_count(spark, tmp_dir):
    m = fixture_matrix(spark, SF_SMALL)
    n = m.count()
    cfg = JobConfig(target_root=tmp_dir)
    r1 = msink.write_matrix(spark, m, cfg)
    r2 = msink.write_matrix(spark, m, cfg)
    assert r1["rows"] == n and r2["rows"] == n
    assert spark.read.parquet(r1["path"]).count() == 2 * n  # append keeps both loads
    r3 = msink.write_matrix(spark, m, JobConfig(target_root=tmp_dir, truncate_before_load=True))
    back = spark.read.parquet(r3["path"])
    assert back.count() == n and "etl_loaded_at" in back.columns
    with pytest.raises(ValueError):
        msink.write_matrix(spark, m.withColumn("sum_7d", F.col("sum_7d").cast("string")), cfg)


def test_a_load_repeated_under_its_run_id_leaves_one_copy(spark, tmp_dir, monkeypatch):
    m = fixture_matrix(spark, SF_SMALL)
    n = m.count()
    cfg = JobConfig(target_root=tmp_dir, run_id="day-1")
    path = msink.target_path(spark, cfg)
    for broken, after in (("move", 1), ("write_text", 0)):  # stopped while files are moved, before the manifest
        real, calls = getattr(snapshot, broken), []

        def stop(*a, real=real, calls=calls, after=after):
            calls.append(a)
            if len(calls) > after:
                raise OSError("stopped")
            return real(*a)

        monkeypatch.setattr(snapshot, broken, stop)
        with pytest.raises(OSError):
            msink.write_matrix(spark, m, cfg)
        monkeypatch.setattr(snapshot, broken, real)
        assert msink.runs(spark, path) == {} and msink.read_target(spark, path).count() == 0
    assert msink.write_matrix(spark, m, cfg)["rows"] == n
    assert msink.write_matrix(spark, m.limit(3), cfg)["rows"] == n  # done already
    assert msink.read_target(spark, path).count() == spark.read.parquet(path).count() == n
    other = msink.write_matrix(spark, m.limit(5), JobConfig(target_root=tmp_dir, run_id="day_2"))
    assert msink.read_target(spark, path).count() == n + 5
    assert msink.read_target(spark, path, other["run_id"]).count() == 5
    assert list(msink.runs(spark, path)) == ["day_1", "day_2"]


def test_a_lookup_opens_files_that_may_hold_the_customer(spark, tmp_dir):
    m = fixture_matrix(spark, SF_SMALL)
    cfg = JobConfig(target_root=tmp_dir)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for _ in range(2):
            msink.write_matrix(spark, m, cfg)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    path = msink.target_path(spark, cfg)
    assert len(msink.read_target(spark, path).inputFiles()) >= 8
    for c in ("cus-1", "cus-77", "cus-99"):
        found = msink.lookup(spark, path, c)
        assert found.count() == 2 and len(found.inputFiles()) == 2  # one of each load
    assert msink.lookup(spark, path, "nobody").count() == 0


def test_snapshot_switch(spark, tmp_dir):
    root = os.path.join(tmp_dir, "snap")
    assert snapshot.read_current(spark, root) is None
    a = spark.range(3)
    snapshot.publish_snapshot(spark, a, root, tag="0")
    snapshot.publish_snapshot(spark, spark.range(5), root, tag="1")
    assert snapshot.read_current(spark, root).count() == 5
    assert snapshot.current_info(spark, root)[1] == "1"


def test_jdbc_options_builder():
    o = tables.jdbc_options("jdbc:x://h/db", "t", user="u", password="p", partition_column="id",
                            lower_bound=0, upper_bound=100, num_partitions=8)
    assert o["numPartitions"] == "8" and o["partitionColumn"] == "id" and o["dbtable"] == "t"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x://h/db", "t", partition_column="id")


def test_job_config_from_env():
    cfg = JobConfig.from_env({"TGT_DB": "a", "TGT_TABLE": "b", "TRUNCATE_BEFORE_LOAD": "1",
                              "HIGH_SPENDER_7D": "5", "MORNING_START": "7"})
    assert cfg.target == "a.b" and cfg.truncate_before_load
    assert cfg.thresholds.high_spender_7d == 5.0 and cfg.thresholds.morning_start == 7


def test_read_table_other_formats(spark, tmp_dir):
    src = tables.read_table(spark, SF_SMALL, "nation")
    src.write.json(os.path.join(tmp_dir, "nation.json"))
    back = tables.read_table(spark, tmp_dir, "nation", fmt="json")
    assert back.count() == src.count() == 25


def test_loader_drop_and_reload(spark, tmp_dir):
    from shoplens.plans import loader

    src, tgt = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "db")
    os.makedirs(src)
    for name in COLLECTION_FILES:
        key = {"products": "id", "customers": "customer_id", "stores": "store_id", "purchases": "purchase_id"}[name]
        _write(os.path.join(src, f"{name}.jsonl"), [f'{{"{key}": "a"}}', f'{{"{key}": "b"}}'])
    loader.run(spark, src, tgt)
    r = loader.run(spark, src, tgt, mode="insert", drop=True)  # reload from empty: no collision
    assert r["stores"] == {"affected": 2, "modified": 0}
    assert snapshot.read_current(spark, os.path.join(tgt, "stores")).count() == 2


def test_known_schemas_match_the_files(spark):
    from pyspark.sql.types import StructType

    for name, ddl in tables.KNOWN_SCHEMAS.items():
        inferred = spark.read.parquet(f"{SF_SMALL}/{name}.parquet").schema
        declared = StructType.fromDDL(ddl)
        assert [(f.name, f.dataType) for f in inferred.fields] == [(f.name, f.dataType) for f in declared.fields], name


def test_failed_snapshot_write_keeps_the_live_version(spark, tmp_dir):
    root = os.path.join(tmp_dir, "snap")
    snapshot.publish_snapshot(spark, spark.range(3), root, tag="0")
    live = snapshot.current(spark, root)
    bad = spark.range(10).selectExpr("id", "CASE WHEN id = 7 THEN raise_error('executor lost') ELSE id END AS v")
    with pytest.raises(Exception):
        snapshot.publish_snapshot(spark, bad, root, tag="1")
    assert snapshot.current(spark, root) == live
    assert snapshot.read_current(spark, root).count() == 3


def test_bad_lines_are_reported_with_line_numbers(spark, tmp_dir):
    path = os.path.join(tmp_dir, "c.jsonl")
    lines = ['{"customer_id": "c%d"}' % i for i in range(5000)]
    lines[2] = ""
    lines[10] = "{bad"
    lines[4321] = '{"customer_id": '
    _write(path, lines)
    # several splits of the same file, so offsets across splits are exercised
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        got = sorted((r.line, r.text) for r in ndjson.bad_lines(spark, path).collect())
        assert spark.read.text(path).rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(11, "{bad"), (4322, '{"customer_id": ')]
    with pytest.raises(ValueError, match="c.jsonl:11, .*c.jsonl:4322"):
        ndjson.validate_ndjson(spark, path)
    good = os.path.join(tmp_dir, "good.jsonl")
    _write(good, ['{"customer_id": "a"}', "", '{"customer_id": "b"}'])
    ndjson.validate_ndjson(spark, good)


def test_a_publish_stopped_between_any_two_steps_leaves_old_or_new(spark, tmp_dir, monkeypatch):
    root = os.path.join(tmp_dir, "snap")
    snapshot.publish_snapshot(spark, spark.range(3), root, tag="0")

    class Stop(Exception):
        pass

    def stop(*_):
        raise Stop

    for step, rows in (("_point", 3), ("_remove_superseded", 5)):
        with monkeypatch.context() as m:
            m.setattr(snapshot, step, stop)
            with pytest.raises(Stop):
                snapshot.publish_snapshot(spark, spark.range(5), root, tag="1")
        assert snapshot.read_current(spark, root).count() == rows
    # the pointer is written but not yet renamed
    real = snapshot._fs
    with monkeypatch.context() as m:
        def fs_without_rename(s, path):
            fs, p = real(s, path)
            if "_CURRENT." in path:
                raise Stop
            return fs, p
        m.setattr(snapshot, "_fs", fs_without_rename)
        with pytest.raises(Stop):
            snapshot._point(spark, root, 99, "x")
    assert snapshot.read_current(spark, root).count() == 5


def test_superseded_snapshots_go_and_a_lost_pointer_is_an_error(spark, tmp_dir):
    import glob

    root = os.path.join(tmp_dir, "snap")
    for n in range(1, 6):
        snapshot.publish_snapshot(spark, spark.range(n), root, tag=str(n))
    assert snapshot.read_current(spark, root).count() == 5
    assert len(os.listdir(os.path.join(root, "snapshots"))) == snapshot.KEPT
    for f in glob.glob(os.path.join(root, "_CURRENT.*")):
        os.remove(f)
    with pytest.raises(snapshot.SnapshotError):
        snapshot.read_current(spark, root)
    with pytest.raises(snapshot.SnapshotError):
        snapshot.publish_snapshot(spark, spark.range(1), root)

from __future__ import annotations

import csv
import io
import random
from datetime import date

import pytest
from pyspark.sql import functions as F, types as T

from rivulet.operators import refresh
from rivulet.plans import staging
from rivulet.sources import files, records, tables
from rivulet.streaming import landing


def test_payload_scan_mixes_delimiters(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Code_BSS; X \nA;1.5\nB;\n")
    (tmp_path / "b.csv").write_text('CODE_BSS,x,extra\nC,"2,5",z\n')
    (tmp_path / "c.csv").write_text("")
    rows = {r.code_bss: (r.x, r.extra)
            for r in files.read_payload_csv(spark, str(tmp_path)).collect()}
    assert rows == {"A": ("1.5", None), "B": (None, None), "C": ("2,5", "z")}


def test_delimiter_rule():
    assert [records.delimiter_of(h) for h in ("a;b", "a,b", "a;b,c", "a")] == [";", ",", ",", ";"]


def test_entity_files(spark, tmp_path):
    latin = tmp_path / "latin.csv"
    latin.write_bytes("Code entité;Libelle EH\n050AA01;Système à nappe\n".encode("latin-1"))
    comma = tmp_path / "comma.csv"
    comma.write_text("code_eh,NiveauEH,other\n050AA01,2,x\n104,1,y\n")
    useless = tmp_path / "useless.csv"
    useless.write_text("code_eh;other\n1;2\n")
    a = files.read_entity_csv(spark, str(latin))
    b = files.read_entity_csv(spark, str(comma))
    assert a.columns == b.columns == files.ENTITY_COLUMNS
    assert a.first().libelle_eh == "Système à nappe"
    assert files.read_entity_csv(spark, str(useless)) is None
    merged = files.merge_best_attributes([a, b]).collect()
    assert [(r.code_eh, r.libelle_eh) for r in merged] == [("050AA01", "Système à nappe")]


def test_entity_files_of_one_folder_have_their_own_encodings(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Code entité;Libelle EH\r\n050AA01;Système à nappe\r\n".encode("latin-1"))
    (tmp_path / "b.csv").write_text('Libelle EH,code_eh\n"Système, dit ""é""\nde nappe",050AA02\n', encoding="utf-8")
    (tmp_path / "c.csv").write_text("code_eh;other\n1;2\n")
    got = files.read_entity_csv(spark, str(tmp_path)).select("code_eh", "libelle_eh").collect()
    assert sorted(map(tuple, got)) == [("050AA01", "Système à nappe"), ("050AA02", 'Système, dit "é"\nde nappe')]


def random_csv(rng, sep):
    """Fields with line breaks, quotes at odd places and separators; the first row is the header."""
    def field():
        kind = rng.random()
        plain = "".join(rng.choice('ab"x ') for _ in range(rng.randint(0, 5)))
        if kind < 0.5:
            return plain.lstrip('"')
        inside = "".join(rng.choice(["a", "\n", '""', sep, "\r\n", " ", "bc", "\n\n"]) for _ in range(rng.randint(0, 8)))
        return f'"{inside}"' + rng.choice(["", "", "tail"])

    lines = [sep.join(["Key", "b", '"C\n 1"' if rng.random() < 0.3 else "C "])]
    for _ in range(rng.randint(0, 60)):
        lines.append(rng.choice(["", sep.join(field() for _ in range(3)), lines[0]]))
    return rng.choice(["\n", "\r\n"]).join(lines) + rng.choice(["", "\n"])


@pytest.mark.parametrize("block", ["16m", "100b", "37b"])
def test_records_across_lines_and_blocks_equal_the_csv_module(spark, tmp_path, block):
    rng = random.Random(block)
    want = []
    for k in range(25):
        sep = rng.choice(";,")
        text = random_csv(rng, sep).replace(";" if sep == "," else ",", "_")
        (tmp_path / f"f{k}.csv").write_bytes(text.encode())
        rows = [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=sep) if "".join(r).strip() or len(r) > 1]
        names = [n.strip().lower() for n in rows[0]]
        for r in rows[1:]:
            found = dict(zip(names, r))
            want.append((found.get("key") or None, found.get("b") or None,
                         found.get("c") or found.get("c\n 1") or None))
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        df = files.read_payload_csv(spark, str(tmp_path))
        last = F.coalesce("c", F.col("`c\n 1`")) if "c\n 1" in df.columns else F.col("c")
        got = [tuple(r) for r in df.select("key", "b", last).collect()]
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert sorted(got, key=str) == sorted(want, key=str)


def test_a_quote_that_is_never_closed_is_told(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "MOST_CHARACTERS", 500)
    (tmp_path / "a.csv").write_text('k;v\n1;"open\n' + "2;3\n" * 500)
    with pytest.raises(ValueError, match="never closed"):
        files.read_payload_csv(spark, str(tmp_path))


def test_landed_layouts_are_read_by_name(spark, tmp_path):
    folder, table = tmp_path / "in", str(tmp_path / "table")
    folder.mkdir()
    (folder / "a.csv").write_text('code;v\na;"1\n1"\n')
    landing.ingest_payloads(spark, str(folder), table, str(tmp_path / "mark")).awaitTermination()
    (folder / "b.csv").write_text("V,extra,CODE\n2,x,b\n")
    (folder / "c.csv").write_text("")
    landing.ingest_payloads(spark, str(folder), table, str(tmp_path / "mark")).awaitTermination()
    rows = tables.read_table(spark, table).select("code", "v", "extra").collect()
    assert sorted(map(tuple, rows)) == [("a", "1\n1", None), ("b", "2", "x")]


def test_header_normalisation():
    assert files.normalize_header("  Code  EH (2) ") == "code_eh_2"
    assert files.normalize_header("!!") == "col"


def test_fallback_ladder(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    full = spark.createDataFrame([(1,)], schema)
    got = files.first_nonempty(spark, None, full.where("false"), lambda: full, schema=schema)
    assert got.first().a == 1
    assert files.first_nonempty(spark, None, schema=schema).count() == 0


def test_seed(spark, tmp_path):
    (tmp_path / "seed.csv").write_text(
        "code_bss,code_bss_nouveau,longitude,latitude,derniere_classe,dernier_ips,derniere_date_calcul\n"
        "X1/P,BSS000AAAA,1.5,50.5,3,-0.7,2026-06-10\n")
    row = files.load_seed(spark, str(tmp_path / "seed.csv")).first()
    assert (row.code_bss, row.derniere_classe, row.dernier_ips) == ("X1/P", 3, -0.7)


def test_empty_extract_keeps_the_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.sql("select 'a' as k, date'2020-05-01' as d, 1 as v")
    tables.upsert_table(df, path, ["k", "d"], "d")
    assert tables.refresh_partition(df.where("false"), path, "d", 2020) is None
    assert tables.read_table(spark, path).count() == 1


def test_backfill_only_and_force(spark, tmp_path):
    ledger, seen = str(tmp_path / "ledger"), []
    tables.run_backfill(spark, "j", ["1", "2"], seen.append, ledger)
    tables.run_backfill(spark, "j", ["1", "2", "3"], seen.append, ledger)
    tables.run_backfill(spark, "j", ["1", "2", "3"], seen.append, ledger, only=["2"], force=True)
    assert seen == ["1", "2", "3", "2"]


def test_key_batches_hold_every_key_once(spark):
    df = spark.range(2500).selectExpr("concat('k', id % 1230) as code")
    rows = files.key_batches(df, "code", 100).collect()
    assert len(rows) == len({r.code for r in rows}) == 1230
    sizes = [sum(r.batch == b for r in rows) for b in range(13)]
    assert sizes == [100] * 12 + [30]


def test_headers_of_files_with_many_blocks(spark, tmp_path):
    """The header is the first line, also when a file is read in blocks and lines repeat."""
    body = "".join(f"k{i};{i}\n" for i in range(60_000))
    (tmp_path / "big.csv").write_text("Key; N\n" + body)
    (tmp_path / "other.csv").write_text("n,key\n7,x\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = files.read_payload_csv(spark, str(tmp_path))
        assert df.select("key", "n").where("key in ('k0', 'k59999', 'x')").orderBy("key").collect() == [
            ("k0", "0"), ("k59999", "59999"), ("x", "7")]
        assert df.count() == 60_001
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def names(path):
    return {p.relative_to(path).as_posix() for p in path.rglob("*.parquet")}


def levels(spark):
    df = spark.sql("""select concat('s', id % 5) as k, date_add(date'2019-01-01', cast(id as int)) as d,
                      cast(id as double) as v from range(1400)""")
    return df.union(spark.sql("select 'undated' as k, cast(null as date) as d, 1.0D as v"))


def test_refreshes_leave_other_partitions_alone(spark, tmp_path):
    path = tmp_path / "t"
    tables.upsert_table(levels(spark), str(path), ["k", "d"], "d", ["k"])
    before = names(path)
    assert {n.split("/")[0] for n in before} == {
        "year=2019", "year=2020", "year=2021", "year=2022", "year=__HIVE_DEFAULT_PARTITION__"}
    fresh = levels(spark).where("d >= '2022-06-01'").withColumn("v", F.lit(-1.0))
    got = tables.refresh_recent(fresh, str(path), "d", 60, "2022-10-31")
    changed = names(path) ^ before
    assert {n.split("/")[0] for n in changed} == {"year=2022"}
    assert got.where("d is null").count() == 1 and got.where("v = -1").count() == 61
    before = names(path)
    got = tables.refresh_range(fresh.limit(0), str(path), "d", "2020-01-01", "2020-12-31")
    assert before - names(path) == {n for n in before if n.startswith("year=2020")}
    assert names(path) < before and got.where("d is null").count() == 1
    more = spark.sql("select 'other' as k, cast(null as date) as d, 2.0D as v")
    got = tables.upsert_table(more, str(path), ["k", "d"], "d")
    assert {r.k for r in got.where("d is null").collect()} == {"undated", "other"}


def test_recomputes_rewrite_only_what_they_touch(spark, tmp_path):
    path, source = tmp_path / "t", levels(spark)
    build = lambda cut: source if cut is None else source.where(F.col("d") >= cut)
    tables.recompute_recent_table(spark, str(path), "d", "2022-10-31", build, days=30)
    before = names(path)
    got = tables.recompute_recent_table(spark, str(path), "d", "2022-10-31", build, days=30)
    assert {n.split("/")[0] for n in names(path) ^ before} == {"year=2022"}
    assert sorted(map(str, got.drop("year").collect())) == sorted(map(str, source.collect()))

    keyed = tmp_path / "keyed"
    total = lambda df: df.groupBy("k").agg(F.sum("v").alias("v"))
    everyone = source.select("k").distinct()
    tables.recompute_active_table(str(keyed), total, source, everyone, "k", parts=16)
    before = names(keyed)
    got = tables.recompute_active_table(str(keyed), total, source, everyone.where("k = 's3'"), "k", parts=16)
    assert len({n.split("/")[0] for n in names(keyed) ^ before}) == 1
    assert sorted(map(str, got.drop(tables.KEY_PART).collect())) == sorted(map(str, total(source).collect()))


def test_a_hot_key_of_one_year_is_written_by_several_tasks(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        df = spark.range(200_000).selectExpr("'hot' as k", "date'2020-02-02' as d", "uuid() as v")
        tables.upsert_table(df, str(tmp_path / "t"), ["k", "d", "v"], "d")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(names(tmp_path / "t")) > 3


def test_replaced_tables_leave_nothing_behind(spark, tmp_path):
    path = tmp_path / "t"
    for n in (3, 5):
        assert tables.refresh_replace(spark.range(n), str(path)).count() == n
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_incremental_staging_prunes_bronze(spark, tmp_path):
    raw = spark.sql("""select concat('s', id % 3) as code_bss, string(date_add(date'2015-01-01', cast(id as int)))
                       as date_mesure, string(id) as niveau_nappe_eau, '1' as profondeur_nappe,
                       year(date_add(date'2015-01-01', cast(id as int))) as year from range(2500)""")
    raw.write.partitionBy("year").parquet(str(tmp_path / "bronze"))
    stations = spark.sql("select concat('s', id) as code_bss from range(3)")
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    old = staging.build_stg_piezo_chroniques(bronze, stations).where("date_mesure < '2021-05-01'")
    new = staging.build_stg_piezo_chroniques(bronze, stations, target=old)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and ">= 2021" in plan
    assert refresh.lookback_bound(old, "date_mesure") == date(2021, 4, 23)
    whole = staging.build_stg_piezo_chroniques(bronze, stations)
    assert refresh.upsert(old, new, ["code_bss", "date_mesure"]).count() == whole.count()


def test_a_repeated_stream_batch_is_split_alike(spark, tmp_path, monkeypatch):
    """A crash after the upsert and before the commit: the restart gives the same tables."""
    table, rejects, mark = (str(tmp_path / n) for n in ("table", "late", "mark"))
    folder = str(tmp_path / "landed")

    def run():
        stream = spark.readStream.schema("k string, d date, v double").parquet(folder)
        landing.stream_upsert(stream, table, mark, ["k", "d"], [("v", "desc")], "d", horizon=10,
                              rejects=rejects).awaitTermination()

    spark.sql("select 'a' as k, date'2024-03-01' as d, 1.0D as v").write.parquet(folder)
    run()
    spark.sql("""select * from values ('x', date'2024-02-25', 2.0D), ('y', date'2024-06-01', 3.0D),
                 ('z', date'2024-01-01', 4.0D) as t(k, d, v)""").write.mode("append").parquet(folder)
    real = landing.upsert_table

    def crash(*args, **kwargs):
        real(*args, **kwargs)
        raise RuntimeError("lost between upsert and commit")

    monkeypatch.setattr(landing, "upsert_table", crash)
    try:
        run()
        raise AssertionError("the crash was swallowed")
    except Exception as exc:
        assert "lost between" in str(exc)
    monkeypatch.setattr(landing, "upsert_table", real)
    run()
    assert {r.k for r in tables.read_table(spark, table).collect()} == {"a", "x", "y"}
    assert {r.k for r in spark.read.parquet(rejects).collect()} == {"z"}


class _Session:
    """As much of a session as finding the shared folder takes."""

    def __init__(self, master, **conf):
        self.sparkContext = type("Context", (), {"master": master})()
        self.conf = type("Conf", (), {"get": lambda _, k, d=None: conf.get(k, d),
                                      "set": lambda _, k, v: conf.__setitem__(k, v)})()


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.scratch_root(_Session("spark://host:7077"))
    named = _Session("spark://host:7077", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert tables.scratch_root(named) == "hdfs:///shared"
    alone = _Session("local[4]")
    assert tables.scratch_root(alone) == tables.scratch_root(alone)


def test_a_failing_switch_keeps_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    tables.refresh_replace(spark.range(5), path)
    real = tables._at

    class NoRename:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return (lambda *_: False) if name == "rename" else getattr(self.fs, name)

    monkeypatch.setattr(tables, "_at", lambda s, p: (lambda fs, at: (NoRename(fs), at))(*real(s, p)))
    with pytest.raises(RuntimeError, match="old one stays"):
        tables.refresh_replace(spark.range(9), path)
    monkeypatch.undo()
    assert tables.read_replaced(spark, path).count() == 5
    begun = tables.read_replaced(spark, path)
    assert tables.refresh_replace(spark.range(7), path).count() == 7
    assert begun.count() == 5  # a reader that has begun still has its version
    for n in (3, 2):
        assert tables.refresh_replace(spark.range(n), path).count() == n
    assert sum(p.name.startswith("v") for p in (tmp_path / "table").iterdir()) == 2


def test_a_moved_row_is_found_in_its_old_year(spark, tmp_path):
    path = str(tmp_path / "moved")
    rows = [(f"k{i}", date(2000 + i % 6, 1, 1), i) for i in range(60)] + [(None, date(2001, 5, 5), 7), ("u", None, 8)]
    kind = "k string, day date, v int"
    tables.upsert_moved(spark.createDataFrame(rows, kind), path, ["k"], "day", parts=8)
    old = {p: p.stat().st_mtime_ns for p in (tmp_path / "moved").rglob("*.parquet")}
    batch = [("k0", date(2003, 7, 7), 100), ("u", date(2003, 8, 8), 101), ("new", date(2003, 9, 9), 102),
             (None, date(2003, 5, 5), 103)]
    for _ in range(2):  # the same corrections twice: keys NULL match nothing and are added again
        out = tables.upsert_moved(spark.createDataFrame(batch, kind), path, ["k"], "day", parts=8)
    want = {(k, d, v) for k, d, v in rows if k not in ("k0", "u")} | set(batch)
    got = [(r.k, r.day, r.v) for r in out.collect()]
    assert set(got) == want and len(got) == len(want) + 1
    same = {p.parent.name for p in old if p.exists()}
    assert same == {"year=2001", "year=2002", "year=2004", "year=2005"}
    places = {(r.k, r.year) for r in tables.read_table(spark, path + "__keys").collect()}
    assert ("k0", 2003) in places and ("k0", 2000) not in places and len(places) == 62


def test_a_batch_without_changes_writes_nothing(spark, tmp_path):
    table, folder = tmp_path / "t", tmp_path / "in"
    rows = [(i, date(2020, 1, 1 + i % 9), float(i)) for i in range(30)]

    def land(some):
        spark.createDataFrame(some, "k int, d date, v double").write.mode("append").parquet(str(folder))
        stream = spark.readStream.schema("k int, d date, v double").parquet(str(folder))
        landing.stream_upsert(stream, str(table), str(tmp_path / "mark"), ["k", "d"], [("v", "desc")], "d",
                              rejects=str(tmp_path / "late")).awaitTermination()
        return {p: p.stat().st_mtime_ns for p in table.rglob("*.parquet")}

    first = land(rows)
    assert land(rows[:20]) == first
    assert land([(1, date(2020, 1, 2), 0.5)]) != first  # a correction wins, lower or not
    assert {(r.k, r.v) for r in tables.read_table(spark, str(table)).collect()} == {
        (i, 0.5 if i == 1 else float(i)) for i in range(30)}
    land([(40, date(2019, 11, 1), 1.0)])
    assert [r.k for r in spark.read.parquet(str(tmp_path / "late")).collect()] == [40]


def test_tasks_of_a_stored_table_are_bounded(spark, monkeypatch):
    """While a table is stored, tasks share at most 16 MB of shuffled rows; a session's figure is kept."""
    from pyspark.sql import DataFrameWriter

    from rivulet.sources import tables

    seen, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (
        seen.append(spark.conf.get(tables.TASK_BYTES)), write(self, *a, **k))[1])
    before = spark.conf.get(tables.TASK_BYTES)
    assert tables.settle(spark.range(5), "few").count() == 5
    assert seen == ["16MB"] and spark.conf.get(tables.TASK_BYTES) == before
    spark.conf.set(tables.TASK_BYTES, "8m")
    try:
        tables.settle(spark.range(5), "few")
    finally:
        spark.conf.unset(tables.TASK_BYTES)
    assert seen == ["16MB", "8m"]


def test_settle_takes_a_smaller_share_a_task(spark, tmp_path, monkeypatch):
    """Stored readings are written by tasks of 8 MB; other tables keep the 16 MB."""
    from checks import chain

    seen = []
    write = tables.settle

    def record(df, name, **more):
        seen.append(more.get("task_bytes"))
        return write(df, name, path=str(tmp_path / name), **more)

    monkeypatch.setattr(chain, "settle", record)

    class Levels(chain.Chain):
        @property
        def levels(self):
            return self.spark.createDataFrame(
                [("ST1", "2001-01-02", 3.0, 1.0)], "code_bss string, date_mesure string,"
                " niveau_nappe_eau double, profondeur_nappe double").withColumn(
                "date_mesure", F.col("date_mesure").cast("date"))

    before = spark.conf.get(tables.TASK_BYTES)
    assert Levels(spark, "").daily_levels.count() == 1
    assert seen == ["8MB"] and spark.conf.get(tables.TASK_BYTES) == before


def test_stored_by_input_uses_more_shuffle_partitions(spark, tmp_path, monkeypatch):
    """A table that outgrows the session's shuffle partitions is written by more tasks, not larger ones."""
    monkeypatch.setattr(tables, "SHUFFLED_SHARE", 128 << 10)
    place = str(tmp_path / "in put")
    spark.range(600_000).select(F.xxhash64("id").alias("k"), "id").write.parquet(place)
    rows = spark.read.parquet(place).groupBy("k").agg(F.max("id").alias("id"))
    keys = (tables.TASK_BYTES, tables.READ_BYTES, tables.FIRST_PARTITIONS)
    before = [spark.conf.get(key, None) for key in keys]
    found = tables.settle(rows, path=str(tmp_path / "out"), task_bytes="256KB", by_input=True)
    assert [spark.conf.get(key, None) for key in keys] == before
    assert len(found.inputFiles()) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert found.agg(F.count("*"), F.sum("id")).first() == (600_000, 600_000 * 599_999 // 2)


def test_readings_are_stored_by_input(monkeypatch):
    from checks import chain

    asked = []
    monkeypatch.setattr(chain, "settle", lambda df, name, **how: asked.append((name, how)) or df)
    monkeypatch.setattr(chain.Chain, "levels", None)
    monkeypatch.setattr(chain.facts, "build_int_daily_measurements", lambda levels: levels)
    chain.Chain(None, "").daily_levels
    assert asked == [("daily_levels", {"task_bytes": "8MB", "by_input": True})]

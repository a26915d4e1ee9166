"""Writing tables: replace, partition and window refresh, export, ledger.

Partitioned tables are Parquet folders split by a ``year`` column and replaced
partition by partition (dynamic overwrite). A whole-table refresh is written to
a staging folder next to the table first, so a lost job never leaves the table
half written without a complete copy beside it.
"""

from __future__ import annotations

import atexit
import shutil
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rivulet.operators import refresh


SCRATCH = "rivulet.scratch.dir"
FOLDER: ContextVar[str | None] = ContextVar("folder of settled tables", default=None)
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
TASK_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
READ_BYTES = "spark.sql.files.maxPartitionBytes"
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
READ_TASK = 32 << 20
SHUFFLED_SHARE = 4 << 20  # bytes of input files a shuffle partition; small ones are joined again
STORED_TASK_BYTES = "16MB"  # compressed; sorted rows of narrow tables take some thirty times that


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for tables between steps.

    ``spark.checkpoint.dir`` if the session has it, else ``rivulet.scratch.dir``. Only a
    session whose driver and executors are one process gets a folder of its own, which
    goes when the process ends. A cluster must name one: a machine's own folder would
    lose rows there.
    """
    for key in ("spark.checkpoint.dir", SCRATCH):
        shared = spark.conf.get(key, None)
        if shared:
            return shared.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError(f"set spark.checkpoint.dir or {SCRATCH} to a folder all executors share")
    folder = f"/tmp/checkpoints/rivulet-{uuid.uuid4().hex}"
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set(SCRATCH, folder)
    return folder


def _input_bytes(df: DataFrame) -> int:
    """Size of the files a table is computed from."""
    spark, total = df.sparkSession, 0
    for uri in df.inputFiles():
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
        total += place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).getLen()
    return total


def settle(df: DataFrame, name: str = "table", path: str | None = None,
           task_bytes: str = STORED_TASK_BYTES, by_input: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage the way a stored table does: later steps do not recompute
    it, a lost executor cannot lose it, and its true size is known to the
    planner, which then broadcasts it only if it is small. Once it is stored, the
    shuffle files that led to it are of no more use and are dropped. Tasks that share
    small shuffle partitions get at most ``task_bytes`` of them (a session's own figure
    is kept). ``by_input`` has a task read at most 32 MB of files and lets the number of
    shuffle partitions grow with the files, as a fixed number of them grows in size: so
    the memory of a task stays the same however large the table.
    """
    spark = df.sparkSession
    target = path or f"{FOLDER.get() or scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    fresh = {DROP_SHUFFLES: "true"}
    if spark.conf.get(TASK_BYTES) in ("64MB", "67108864b"):  # Spark's default
        fresh[TASK_BYTES] = task_bytes
    if by_input:
        if spark.conf.get(READ_BYTES) in ("128MB", "134217728b"):  # Spark's default
            fresh[READ_BYTES] = str(READ_TASK)
        first = spark.conf.get(FIRST_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
        fresh[FIRST_PARTITIONS] = str(max(int(first or 1), -(-_input_bytes(df) // SHUFFLED_SHARE)))
    before = {key: spark.conf.get(key, None) for key in fresh}
    for key, value in fresh.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(target)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(target)


def _at(spark: SparkSession, path: str):
    """(file system, path) of the session's own Hadoop client."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


@contextmanager
def settled_in(spark: SparkSession, name: str) -> Iterator[str]:
    """Tables settled inside go to a folder of their own, which is given.

    Its user drops the folder (``remove``) when nothing reads the tables any more.
    """
    folder = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    token = FOLDER.set(folder)
    try:
        yield folder
    finally:
        FOLDER.reset(token)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of tables, if it is there."""
    fs, place = _at(spark, path)
    fs.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def _with_year(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn("year", F.year(day))


def _replace_parts(df: DataFrame, path: str, part: str, order: Sequence[str] = ()) -> None:
    """Overwrite only the partitions present in ``df``.

    Rows are rebalanced by partition: a large partition goes to several tasks of
    about the advisory size, small ones share a task, whatever the keys in them.
    """
    keys = [c for c in order if c in df.columns]
    (df.hint("rebalance", part).sortWithinPartitions(part, *keys).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path))


POINTERS = "_pointers"


def _pointers(spark: SparkSession, path: str) -> list[str]:
    """Pointer files of a table, oldest first."""
    fs, place = _at(spark, f"{path}/{POINTERS}")
    if not fs.exists(place):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(place) if not f.getPath().getName().startswith("."))


def read_replaced(spark: SparkSession, path: str) -> DataFrame:
    """The present version of a table that ``refresh_replace`` writes."""
    path = path.rstrip("/")
    known = _pointers(spark, path)
    return spark.read.parquet(f"{path}/{known[-1].split('-', 1)[1]}" if known else path)


def refresh_replace(df: DataFrame, path: str) -> DataFrame:
    """Whole-table refresh: readers see the old table or the new one, never none.

    A version is a folder of its own. The last pointer file names the one that counts; it
    appears, by one rename, when its version is complete. If that fails the old version
    stays and an error is raised. The version before is kept for readers that have begun,
    older ones go.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    known = _pointers(spark, path)
    number = int(known[-1].split("-", 1)[0]) + 1 if known else 0
    version = f"v{number:012d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    fs, draft = _at(spark, f"{path}/{POINTERS}/.{version}")
    fs.mkdirs(draft.getParent())
    fs.create(draft).close()
    if not fs.rename(draft, _at(spark, f"{path}/{POINTERS}/{number:012d}-{version}")[1]):
        fs.delete(draft, False)
        remove(spark, f"{path}/{version}")
        raise RuntimeError(f"could not switch {path} to its new version; the old one stays")
    for old in known[:-1]:
        remove(spark, f"{path}/{POINTERS}/{old}")
        remove(spark, f"{path}/{old.split('-', 1)[1]}")
    return read_replaced(spark, path)


def refresh_partition(df: DataFrame, path: str, day: str, year: int,
                      sort: Sequence[str] = ()) -> DataFrame | None:
    """Replace one year. An empty extract changes nothing and returns None."""
    rows = _with_year(df.where(F.year(day) == year), day)
    if rows.isEmpty():
        return None
    _replace_parts(rows, path, "year", sort)
    return read_table(df.sparkSession, path)


def _files(spark: SparkSession, path: str, part: str) -> dict[str, frozenset[str]]:
    """Names of the data files in each partition folder."""
    fs, place = _at(spark, path)
    found = {}
    for folder in fs.listStatus(place):
        name = folder.getPath().getName()
        if folder.isDirectory() and name.startswith(f"{part}="):
            found[name] = frozenset(f.getPath().getName() for f in fs.listStatus(folder.getPath()))
    return found


def _rewrite(spark: SparkSession, path: str, part: str, touched: Column,
             change: Callable[[DataFrame | None], DataFrame], sort: Sequence[str] = ()
             ) -> DataFrame:
    """Read the touched partitions, change them, write them back; the others are not opened.

    ``touched`` is over the partition column, false or NULL for those to leave
    alone; ``change`` gets their rows (None if there is no table yet) and returns
    what they hold from now on, with the partition column. Dynamic overwrite swaps
    partitions at commit, so it may read the table it writes. A touched partition
    that got no rows is left as it was by the write; its folder is removed after.
    """
    if not exists(spark, path):
        _replace_parts(change(None), path, part, sort)
        return read_table(spark, path)
    table = read_table(spark, path)
    inside = F.coalesce(touched, F.lit(False))
    kept_type = table.schema[part].dataType.simpleString()
    before = _files(spark, path, part)
    names = spark.createDataFrame([(n.split("=", 1)[1],) for n in before], "name string")
    value = F.when(F.col("name") != "__HIVE_DEFAULT_PARTITION__", F.col("name")).cast(kept_type)
    hit = {f"{part}={r['name']}" for r in names.withColumn(part, value).where(inside)
           .select("name").collect()}
    _replace_parts(change(table.where(inside)), path, part, sort)
    after = _files(spark, path, part)
    for name in hit:
        if after.get(name) == before[name]:
            remove(spark, f"{path}/{name}")
    return read_table(spark, path)


def _by_year(df: DataFrame, path: str, day: str, touched: Column,
             change: Callable[[DataFrame], DataFrame], sort: Sequence[str]) -> DataFrame:
    def with_years(old: DataFrame | None) -> DataFrame:
        return _with_year(change(df.limit(0) if old is None else old.drop("year")), day)

    return _rewrite(df.sparkSession, path, "year", touched, with_years, sort)


def refresh_recent(df: DataFrame, path: str, day: str, days: int, as_of: date | str,
                   sort: Sequence[str] = ()) -> DataFrame:
    """Delete the last ``days`` days, append the re-fetched ones; other years stay untouched.

    Stored rows without a day stay too.
    """
    cut = F.date_sub(F.lit(str(as_of)).cast("date"), days)
    return _by_year(df, path, day, F.col("year") >= F.year(cut),
                    lambda old: refresh.replace_recent(old, df, day, days, as_of), sort)


def refresh_range(df: DataFrame, path: str, ts: str, start, end, sort: Sequence[str] = ()
                  ) -> DataFrame:
    years = F.col("year").between(F.year(F.lit(str(start)).cast("date")),
                                  F.year(F.lit(str(end)).cast("date")))
    return _by_year(df, path, ts, years,
                    lambda old: refresh.replace_range(old, df, ts, start, end), sort)


def upsert_table(df: DataFrame, path: str, keys: Sequence[str], day: str,
                 sort: Sequence[str] = ()) -> DataFrame:
    """Delete + insert by key in the years the batch touches, that of no day included.

    ``day`` must be part of the key, or corrections could move between years. Keys
    with a NULL part match nothing, as in SQL: such rows are added, none is deleted.
    """
    if day not in keys:
        raise ValueError(f"{day} must be one of the keys {list(keys)}")
    batch = settle(df, "batch")
    years = [r[0] for r in batch.select(F.year(day)).distinct().collect()]
    touched = F.col("year").isin([y for y in years if y is not None])
    if None in years:
        touched = touched | F.col("year").isNull()
    return _by_year(batch, path, day, touched, lambda old: refresh.upsert(old, batch, keys), sort)


def changed_rows(batch: DataFrame, path: str, day: str) -> DataFrame:
    """The rows that the table, partitioned by the year of ``day``, does not hold just so."""
    spark = batch.sparkSession
    if not exists(spark, path):
        return batch
    years = [r[0] for r in batch.select(F.year(day)).distinct().collect()]
    touched = F.col("year").isin([y for y in years if y is not None])
    if None in years:
        touched = touched | F.col("year").isNull()
    stored = read_table(spark, path).where(touched)
    lacking = [c for c in batch.columns if c not in stored.columns]
    stored = stored.withColumns({c: F.lit(None) for c in lacking}).select(
        *[F.col(c).alias(f"_{k}") for k, c in enumerate(batch.columns)])
    same = [F.col(c).eqNullSafe(F.col(f"_{k}")) for k, c in enumerate(batch.columns)]
    return batch.join(stored, same, "left_anti")


def _key_index(spark: SparkSession, path: str, keys: Sequence[str], parts: int) -> str:
    """The folder that tells the years of each key, by a hash of the key; built from the table if need be."""
    index = f"{path.rstrip('/')}__keys"
    if not exists(spark, index) and exists(spark, path):
        known = read_table(spark, path).select(*keys, F.col("year").cast("int").alias("year"))
        _replace_parts(_by_key(known.distinct(), keys, parts), index, KEY_PART)
    return index


def _by_key(df: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    whole = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    return whole.withColumn(KEY_PART, F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))


def upsert_moved(df: DataFrame, path: str, keys: Sequence[str], day: str, parts: int = 64,
                 sort: Sequence[str] = ()) -> DataFrame:
    """Delete + insert by key where a correction may move a row to another year.

    An index beside the table tells the years that hold a key. It is split by a hash of
    the key into ``parts`` folders, and only those of the batch's keys are read, so the old
    row is found without opening other years. New places are indexed before the
    table is written and old ones dropped after, so a lost job leaves the index with too
    many years, never with too few. Keys with a NULL part match nothing: such rows are added.
    """
    spark, batch = df.sparkSession, settle(df, "batch")
    index = _key_index(spark, path, keys, parts)
    new = settle(_by_key(batch.select(*keys, F.year(day).alias("year")).distinct(), keys, parts), "keys")
    parts_hit = [r[0] for r in new.select(KEY_PART).distinct().collect()]
    hit = F.col(KEY_PART).isin(parts_hit)
    years = {r[0] for r in batch.select(F.year(day)).distinct().collect()}
    if exists(spark, index):
        old = read_table(spark, index).where(hit).join(new.select(*keys).distinct(), list(keys), "left_semi")
        years |= {r[0] for r in old.select("year").distinct().collect()}

    def with_new(known: DataFrame | None) -> DataFrame:
        return new if known is None else known.unionByName(new).distinct()

    def only_new(known: DataFrame) -> DataFrame:
        return refresh.upsert(known, new, keys)

    if parts_hit:
        _rewrite(spark, index, KEY_PART, hit, with_new)
    touched = F.col("year").isin([y for y in years if y is not None])
    if None in years:
        touched = touched | F.col("year").isNull()
    out = _by_year(batch, path, day, touched, lambda rows: refresh.upsert(rows, batch, keys), sort)
    if parts_hit:
        _rewrite(spark, index, KEY_PART, hit, only_new)
    return out


def recompute_recent_table(spark: SparkSession, path: str, day: str, as_of: date | str,
                           build: Callable[[Column | None], DataFrame], days: int | None = None,
                           months: int | None = None, sort: Sequence[str] = ()) -> DataFrame:
    """``recompute_recent`` on a table partitioned by year: only the last years are rewritten."""
    cut = refresh.recent_cut(as_of, days, months)

    def change(old: DataFrame | None) -> DataFrame:
        rows = build(None) if old is None else refresh.recompute_recent(
            build, old.drop("year"), day, as_of, days, months)
        return _with_year(rows, day)

    return _rewrite(spark, path, "year", F.col("year") >= F.year(cut), change, sort)


def recompute_months_table(path: str, aggregate: Callable[[DataFrame], DataFrame],
                           roll: Callable[[DataFrame], DataFrame], daily: DataFrame, day: str,
                           month: str, months: int = 25, sort: Sequence[str] = ()) -> DataFrame:
    """``recompute_months`` on a monthly table partitioned by year.

    The rolling context is read from all stored months; the years from the first
    recomputed month on are rewritten.
    """
    spark = daily.sparkSession
    top = refresh.latest(read_table(spark, path), month) if exists(spark, path) else None
    if top is None:
        return _rewrite(spark, path, "year", F.lit(True),
                        lambda _: _with_year(roll(aggregate(daily)), month), sort)
    since = F.year(F.add_months(F.lit(str(top)).cast("date"), -months))
    whole = refresh.recompute_months(aggregate, roll, daily, day,
                                     read_table(spark, path).drop("year"), month, months)
    return _rewrite(spark, path, "year", F.col("year") >= since,
                    lambda _: _with_year(whole, month).where(F.col("year") >= since), sort)


KEY_PART = "key_part"


def with_key_part(df: DataFrame, key: str, parts: int) -> DataFrame:
    """The partition column of tables that are refreshed key by key."""
    return df.withColumn(KEY_PART, F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))


def recompute_active_table(path: str, build: Callable[[DataFrame], DataFrame], source: DataFrame,
                           active: DataFrame, key: str, parts: int = 64,
                           sort: Sequence[str] = ()) -> DataFrame:
    """``recompute_active`` on a table partitioned by a hash of the key.

    Only partitions that hold an active key are rewritten. ``parts`` is a property
    of the table: every refresh must name the same number.
    """
    spark = source.sparkSession
    hit = [r[0] for r in with_key_part(active.select(key), key, parts).select(KEY_PART)
           .distinct().collect()]

    def change(old: DataFrame | None) -> DataFrame:
        rows = build(source) if old is None else refresh.recompute_active(
            build, source, active, old.drop(KEY_PART), key)
        return with_key_part(rows, key, parts)

    return _rewrite(spark, path, KEY_PART, F.col(KEY_PART).isin(hit), change, sort)


def store_split(labelled: DataFrame, path: str, reason: str = "rejection_reason"
                ) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of labelled rows, written in one pass.

    The raw rows are scanned and joined once; either part is then a partition of its
    own. ``labelled`` comes from ``quality.labelled_rejects``.
    """
    labelled.withColumn("rejected", F.col(reason).isNotNull()).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").partitionBy("rejected").parquet(path)
    stored = labelled.sparkSession.read.schema(
        labelled.schema.add("rejected", "boolean")).parquet(path)
    accepted = stored.where(~F.col("rejected")).drop("rejected", reason)
    return accepted, stored.where(F.col("rejected")).drop("rejected")


def export_tables(tables: Mapping[str, DataFrame], out: str, fmt: str = "parquet") -> list[str]:
    """Flat export of every non-empty table: zstd Parquet or gzip TSV with a header."""
    written = []
    for name, df in tables.items():
        if df.isEmpty():
            continue
        writer = df.write.mode("overwrite")
        if fmt == "tsv":
            flat = df.select(*[F.to_json(f.name).alias(f.name)
                               if f.dataType.typeName() in ("struct", "array", "map")
                               else F.col(f.name) for f in df.schema.fields])
            flat.write.mode("overwrite").csv(f"{out}/{name}", sep="\t", header=True,
                                             compression="gzip")
        else:
            writer.parquet(f"{out}/{name}", compression="zstd")
        written.append(name)
    return written


# ---- restartable backfill ------------------------------------------------------

LEDGER_SCHEMA = "job string, partition string, status string, error string, at timestamp"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    if exists(spark, path):
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    return spark.createDataFrame([], LEDGER_SCHEMA)


def pending_partitions(partitions: DataFrame, ledger: DataFrame, job: str,
                       only: Sequence[str] | None = None, force: bool = False) -> DataFrame:
    """Partitions to run: allow-listed, and not completed unless forced."""
    todo = partitions.where(F.col("partition").isin(*only)) if only is not None else partitions
    if force:
        return todo
    last = ledger.where(F.col("job") == job).groupBy("partition").agg(
        F.max_by("status", "at").alias("status"))
    return todo.join(last.where("status = 'completed'"), "partition", "left_anti")


def run_backfill(spark: SparkSession, job: str, partitions: Iterable[str],
                 fn: Callable[[str], object], ledger: str, only: Sequence[str] | None = None,
                 force: bool = False, keep_going: bool = False) -> dict[str, str]:
    """Run a Spark job per partition and record each step, so that a rerun resumes."""
    asked = spark.createDataFrame([(str(p),) for p in partitions], "partition string")
    todo = pending_partitions(asked, read_ledger(spark, ledger), job, only, force)
    outcome: dict[str, str] = {}
    for row in todo.orderBy("partition").collect():
        name = row["partition"]
        _log(spark, ledger, job, name, "running")
        try:
            fn(name)
        except Exception as exc:
            outcome[name] = "failed"
            _log(spark, ledger, job, name, "failed", str(exc))
            if not keep_going:
                raise
        else:
            outcome[name] = "completed"
            _log(spark, ledger, job, name, "completed")
    return outcome


def _log(spark: SparkSession, ledger: str, job: str, partition: str, status: str,
         error: str | None = None) -> None:
    now = datetime.now(timezone.utc)
    (spark.createDataFrame([(job, partition, status, error, now)], LEDGER_SCHEMA)
     .coalesce(1).write.mode("append").parquet(ledger))

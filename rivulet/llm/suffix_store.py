"""A stored family of suffix arrays, to which batches of documents are added.

Each batch becomes suffix arrays by shard (see ``suffix_dedup``) that are merge-scanned
against the levels stored so far; what an earlier batch holds is covered. Levels of like
size then merge, and only merged levels are written: a stored level never changes, so a
level stays in the folder of the batch that wrote it until it has gone into a larger one.

Two indexes are kept, one of runs and one of the single windows of runs whose gram stands
in several contexts. A stored run enters the second one when a batch brings the first other
context of its gram; its text is then read from the texts kept beside the levels.

The manifest names the levels that count. It is swapped as a whole at the end of an
addition: one that fails leaves the index as it was.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.llm import suffix_dedup
from rivulet.llm.common import settle, text_or_empty
from rivulet.llm.suffix_dedup import LevelFamily, Suffixes, Table, U, pack, unpack
from rivulet.sources.tables import exists, read_replaced, refresh_replace, remove

STORED = np.iinfo(np.int64).min  # documents of batch k are known as STORED + k
LEAST = STORED + (1 << 32)  # least id of a document
NEW = -1  # level of a batch's own arrays
PIECE = 40_000  # suffixes in a stored row, about 1 MB
COVERED, EDGE, LEVEL = 0, 1, 2

ARRAYS = "shard int, born int, level int, piece int, first_doc bigint, suffixes binary"
GROWN = "kind int, shard int, born int, level int, piece int, doc bigint, hash bigint, data binary"
MANIFEST = "part string, shard int, born int, level int, name string, bytes bigint, shards int, match int"


def _split(shards: int):
    """Rows of stored levels to the shards that their suffixes have among ``shards``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                born, level, piece = (batch.column(c)[row].as_py() for c in ("born", "level", "piece"))
                part, _, ids, hashes = unpack(batch.column("suffixes")[row].as_py())
                home = (part.key >> U(32)) * U(shards) >> U(32)
                cuts = np.searchsorted(home, np.arange(shards + 1, dtype=np.uint64))
                for s in np.flatnonzero(np.diff(cuts)).tolist():
                    blob = pack(part.take(slice(cuts[s], cuts[s + 1])), part.take(slice(0, 0)),
                                SimpleNamespace(ids=ids, hashes=hashes))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], t) for v, t in zip(
                            (s, born, level, piece, STORED, blob),
                            (*[pa.int32()] * 4, pa.int64(), pa.binary()))],
                        ["shard", "born", "level", "piece", "first_doc", "suffixes"])

    return run


def _new_edges(index: Suffixes, fresh: np.ndarray) -> Suffixes:
    """Suffixes whose gram has come to stand in several documents, by those of the batch.

    ``fresh`` tells the batch's documents by number. Where two stored documents have the
    gram, their suffixes have been given before.
    """
    gram, doc = index.key >> U(24), index.doc.astype(np.int64)
    first = np.flatnonzero(np.diff(gram, prepend=~gram[:1]) != 0)
    ours = fresh[index.doc]
    old_least = np.minimum.reduceat(np.where(ours, len(fresh), doc), first)
    old_most = np.maximum.reduceat(np.where(ours, -1, doc), first)
    mixed = np.logical_or.reduceat(ours, first) & (
        np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first))
    sizes = np.diff(np.append(first, len(index)))
    return index.take(np.repeat(mixed, sizes) & (ours | ~np.repeat(old_least < old_most, sizes)))


def _grow(number: int, with_edges: bool, resharded: bool):
    """A shard's stored levels and the arrays of batch ``number`` to what is covered, edges and levels."""
    def run(group: pa.Table) -> pa.Table:
        born, level, piece, first = (group.column(c).to_numpy() for c in ("born", "level", "piece", "first_doc"))
        order = np.lexsort((first, piece, level, born)).tolist()
        opened = [unpack(group.column("suffixes")[i].as_py()) for i in order]
        table = Table(np.concatenate([o[2] for o in opened]), np.concatenate([o[3] for o in opened]))
        numbers = np.split(table.number, np.cumsum([len(o[2]) for o in opened])[:-1])
        stored, arrays, covered = {}, [], []
        for i, (part, lost, _, _), docs in zip(order, opened, numbers):
            part.doc, lost.doc = docs[part.doc], docs[lost.doc]
            if level[i] == NEW:
                arrays.append(part)
                covered.append(lost)
            else:
                stored.setdefault((int(born[i]), int(level[i])), []).append(part)
        family = LevelFamily(table.ids)
        family.covered = covered
        named = sorted(((Suffixes.joined(parts), name) for name, parts in stored.items()),
                       key=lambda x: -len(x[0]))
        family.levels = [part for part, _ in named]
        for part in arrays:
            if len(part):
                family.add(part)
        fresh, shard = table.ids >= LEAST, group.column("shard")[0].as_py()
        rows = []
        if covered:
            lost = Suffixes.joined(family.covered)
            rows += [(COVERED, None, None, None, d, r) for d, r in suffix_dedup._pack_ranges(lost.take(fresh[lost.doc]))]
        if with_edges and any(map(len, arrays)):
            rows += [(EDGE, None, None, None, d, r)
                     for d, r in suffix_dedup._pack_ranges(_new_edges(family.merged(), fresh))]
        names = {} if resharded else {id(part): name for part, name in named}
        known = SimpleNamespace(ids=np.where(fresh, STORED + number, table.ids), hashes=table.hashes)
        for k, part in enumerate(family.levels):
            if id(part) in names:  # stays where it is
                rows.append((LEVEL, *names[id(part)], 0, None, None))
            else:
                rows += [(LEVEL, number, k, at // PIECE, None,
                          pack(part.take(slice(at, at + PIECE)), part.take(slice(0, 0)), known))
                         for at in range(0, len(part), PIECE)]
        kind, born, level, piece, doc, data = zip(*rows) if rows else [()] * 6
        number_of = [None if d is None else int(d) for d in doc]
        ints = [pa.array(c, pa.int32()) for c in (kind, [shard] * len(rows), born, level, piece)]
        ids, hashes = ([None if d is None else int(x[d]) for d in number_of] for x in (table.ids, table.hashes))
        return pa.Table.from_arrays(
            [*ints, pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(data, pa.binary())],
            ["kind", "shard", "born", "level", "piece", "doc", "hash", "data"])

    return run


class SuffixIndex:
    """An index in the folder ``path``, which all executors share. One writer at a time.

    ``shard_bytes`` is the text behind one shard; shards double in number as the text
    grows, and the levels are dealt anew then.
    """

    def __init__(self, spark: SparkSession, path: str, match: int = 50, shard_bytes: int = 16 << 20):
        suffix_dedup.check_options(match)
        self.spark, self.path, self.match, self.shard_bytes = spark, path.rstrip("/"), match, shard_bytes

    def manifest(self) -> DataFrame:
        """Levels that count (part ``runs`` or ``windows``) and batches added (part ``batch``)."""
        if exists(self.spark, f"{self.path}/manifest"):
            return read_replaced(self.spark, f"{self.path}/manifest")
        return self.spark.createDataFrame([], MANIFEST)

    def add(self, docs: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text",
            carry: tuple[str, ...] = (), whole: bool = False) -> DataFrame:
        """Add a batch; gives doc_id, n_bytes, spans and kept of its rows, as ``remove_repeats`` does.

        A byte goes if it lies under a string of ``match`` bytes that also starts in a document
        of an earlier batch, or of this batch with a smaller id. So batches whose ids grow
        give what one call over all of them gives; the order of arrival decides otherwise.
        Documents added before are not judged again.

        ``name`` is the batch's own: a batch whose name the index has is not added again, and its
        rows are cut as they were then. Rows and texts are treated as ``remove_repeats`` treats
        them (NULL text, NULL id, rows that share an id within the batch, other columns); ids below -2**63 + 2**32
        raise an error. An empty batch only leaves its name.
        """
        suffix_dedup.check_options(self.match, carry)
        old = self.manifest()
        added = old.where("part = 'batch'")
        state = added.agg(F.max("born").alias("born"), F.sum("bytes").alias("bytes"), F.max("shards").alias("shards"),
                          F.max("match").alias("match"),
                          F.max(F.when(F.col("name") == name, F.col("born"))).alias("this")).first()
        if state["match"] not in (None, self.match):
            raise ValueError(f"the index is of matches of {state['match']} bytes")
        if state["this"] is None:
            number = 0 if state["born"] is None else state["born"] + 1
            self._add(docs, name, id_col, text_col, old, number, state["bytes"] or 0, state["shards"] or 1)
        else:
            number = state["this"]
        found = self.spark.read.schema("doc bigint, hash bigint, ranges binary").parquet(
            f"{self.path}/found/born={number}")
        return suffix_dedup.without_windows(docs, found, self.match, id_col, text_col, carry, whole)

    def _add(self, docs: DataFrame, name: str, id_col: str, text_col: str, old: DataFrame,
             number: int, before: int, shards: int) -> None:
        doc = suffix_dedup.order_id(id_col)
        refused = F.raise_error(F.lit("an id below the least one")).cast("bigint")
        texts = docs.select(F.when(doc < F.lit(int(LEAST)), refused).otherwise(doc).alias("doc"),
                            text_or_empty(text_col).alias("text")).select("doc", F.xxhash64("text").alias("hash"), "text")
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        now = max(shards, 1 << math.ceil(math.log2(max(1, (before + size) / self.shard_bytes))))
        # of equal texts one is enough: they have the same runs
        (texts.where(F.octet_length("text") >= self.match).dropDuplicates(["hash"]).select("hash", "text")
         .write.mode("overwrite").parquet(f"{self.path}/texts/born={number}"))

        runs = self._step("runs", texts.mapInArrow(suffix_dedup._index_texts(self.match, now), suffix_dedup.EMITTED),
                          old, number, now, shards)
        edges = runs.where(F.col("kind") == EDGE).groupBy("doc", "hash").agg(F.collect_list("data").alias("ranges"))
        kept = self._read("texts", "hash bigint, text string", number)
        wanted = edges.where(F.col("doc") < F.lit(int(LEAST))).withColumn(
            "born", (F.col("doc") - F.lit(int(STORED))).cast("int"))
        columns = ["doc", "hash", "text", "ranges"]
        mixed = texts.join(edges, ["doc", "hash"]).select(columns).union(
            kept.join(wanted, ["born", "hash"]).select(columns))
        windows = self._step("windows", mixed.mapInArrow(suffix_dedup._index_edges(self.match, now), suffix_dedup.EMITTED),
                             old, number, now, shards)
        covered = runs.union(windows).where(F.col("kind") == COVERED)
        (covered.select("doc", "hash", F.col("data").alias("ranges"))
         .write.mode("overwrite").parquet(f"{self.path}/found/born={number}"))

        levels = [x.where(F.col("kind") == LEVEL).select(F.lit(part).alias("part"), "shard", "born", "level").distinct()
                  for part, x in (("runs", runs), ("windows", windows))]
        this = self.spark.createDataFrame([("batch", None, number, None, name, size, now, self.match)], MANIFEST)
        refresh_replace(this.union(old.where("part = 'batch'")).unionByName(
            levels[0].union(levels[1]), allowMissingColumns=True), f"{self.path}/manifest")
        self._drop_merged()

    def _read(self, part: str, schema: str, number: int) -> DataFrame:
        """A table of the batches before ``number``, with the batch as ``born``."""
        if not number:
            return self.spark.createDataFrame([], f"{schema}, born int")
        return self.spark.read.schema(f"{schema}, born int").parquet(f"{self.path}/{part}").where(
            F.col("born") < number)

    def _step(self, part: str, arrays: DataFrame, old: DataFrame, number: int, shards: int, before: int) -> DataFrame:
        """Scan a batch's arrays against the levels of an index and store the levels that are new."""
        live = old.where(F.col("part") == part).select("shard", "born", "level")
        stored = self._read(part, "shard int, level int, piece int, data binary", number).join(
            live, ["shard", "born", "level"], "left_semi").select(
            "shard", "born", "level", "piece", F.lit(int(STORED)).alias("first_doc"), F.col("data").alias("suffixes"))
        if shards != before:
            stored = stored.mapInArrow(_split(shards), ARRAYS)
        fresh = arrays.select("shard", F.lit(number).alias("born"), F.lit(NEW).alias("level"), F.lit(0).alias("piece"),
                              "first_doc", "suffixes")
        grown = settle(fresh.union(stored).groupBy("shard").applyInArrow(
            _grow(number, part == "runs", shards != before), GROWN), part)
        (grown.where((F.col("kind") == LEVEL) & F.col("data").isNotNull()).select("shard", "level", "piece", "data")
         .write.mode("overwrite").parquet(f"{self.path}/{part}/born={number}"))
        return grown

    def _drop_merged(self) -> None:
        """Remove folders of which no level counts any more."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        live = {(r["part"], f"born={r['born']}") for r in self.manifest().where("part <> 'batch'")
                .select("part", "born").distinct().collect()}
        for part in ("runs", "windows"):
            place = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
            for folder in place.getFileSystem(conf).listStatus(place):
                if (part, folder.getPath().getName()) not in live:
                    remove(self.spark, folder.getPath().toString())

"""Document store on parquet: immutable change folders and a thin manifest.

Every change writes its rows under a folder with a name of its own, ``changes/<id>/<table>``, and becomes
visible as a whole when one row naming that folder is added to ``manifest``. Nothing is overwritten, so
writers do not disturb each other and what a failed change leaves behind is never read. A deletion hides the
rows of its ids from earlier changes; ``compact`` rewrites what is left and lists the changes it read, which later
readers leave out, so a change that is published meanwhile is neither lost nor read twice. Changes are ordered
by the number in their manifest row, equal numbers of simultaneous writers by the id. IDF snapshots are kept under
their ids, so a search can use the one of an earlier time.

Every operation reads the manifest once and works on that snapshot.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import cached_property, reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexspark.operators.batch_search import batch_search
from lexspark.operators.documents import get_document, get_documents
from lexspark.operators.idf import document_frequency, idf_snapshot, merge_idf
from lexspark.operators.index import build_index, with_token_flag
from lexspark.operators.search import DEFAULT_K, search
from lexspark.session import SORT_SPLIT_BYTES, broadcast_if_few, small_splits
from lexspark.sources.json_docs import ACCEPTED, decode_documents

NO_TOKENS, NO_ID = "no_tokens", "no_id"
MANIFEST_COLUMNS = "number bigint, id string, kind string, key string, n_documents bigint, folded array<string>"
MANIFEST_SCHEMA = f"{MANIFEST_COLUMNS}, made_at timestamp"
#: Kinds of changes that hold documents, and kinds that delete ids.
HOLDING, DELETING = ("compact", "append", "replace"), ("replace", "delete")
#: Ids for which the Bloom filter of a row group is made; without a number each takes a megabyte.
BLOOM_IDS = 2**16


class Snapshot:
    """The state of a store as of one reading of its manifest: the changes that no compaction has read yet,
    compactions among them."""

    def __init__(self, store: DocumentStore, changes: list[Row]) -> None:
        self.store, self.changes = store, changes

    def place(self, change: Row) -> str:
        """Sorts like the order of changes. A compaction has the number of the last change it read and comes
        before others of that number, so what they delete is deleted from it too."""
        return f"{change['number']:020d}-{'' if change['kind'] == 'compact' else change['id']}"

    @cached_property
    def places(self) -> dict[str, int]:
        """The changes' ids with their number in the order of places."""
        order = {place: i for i, place in enumerate(sorted({self.place(c) for c in self.changes}))}
        return {c["id"]: order[self.place(c)] for c in self.changes}

    def read(self, table: str, kinds: tuple[str, ...], after: int = -1) -> DataFrame:
        """Rows of a table with the place of their change, of the changes after a place."""
        schema = self.store.schemas[table]
        wanted = [c for c in self.changes if c["kind"] in kinds and self.places[c["id"]] > after]
        parts = [
            self.store.open(table, c["id"]).withColumn("_place", F.lit(self.places[c["id"]])) for c in wanted
        ]
        if not parts:
            return self.store.spark.createDataFrame([], f"{schema}, _place int")
        return reduce(DataFrame.unionByName, parts)

    @cached_property
    def deletions(self) -> DataFrame | None:
        """``(doc_id, _deleted)``: the last deletion per id that can hide something; None if there was none.

        What the first change with documents deletes, and what was deleted before it, hides nothing.
        """
        first = min((self.places[c["id"]] for c in self.changes if c["kind"] in HOLDING), default=len(self.changes))
        if not any(c["kind"] in DELETING and self.places[c["id"]] > first for c in self.changes):
            return None
        rows = self.read("deletions", DELETING, after=first)
        numbers = isinstance(rows.schema["doc_id"].dataType, T.NumericType)
        return broadcast_if_few(rows.groupBy("doc_id").agg(F.max("_place").alias("_deleted")), times=8 if numbers else 1)

    def _split(self, table: str, how: str) -> DataFrame:
        rows = self.read(table, HOLDING)
        if self.deletions is None:
            return (rows if how == "left_anti" else rows.limit(0)).drop("_place")
        gone = self.deletions.withColumnRenamed("doc_id", "_id")
        hidden = (F.col("doc_id") == F.col("_id")) & (F.col("_place") < F.col("_deleted"))
        return rows.join(gone, hidden, how).drop("_place")

    def current(self, table: str) -> DataFrame:
        return self._split(table, "left_anti")

    def hidden(self, table: str) -> DataFrame:
        """Rows that later changes deleted."""
        return self._split(table, "left_semi")

    def documents(self) -> DataFrame:
        return self.current("documents").filter(F.col("status") == ACCEPTED).drop("status")

    def postings(self) -> DataFrame:
        return self.current("postings")

    def rejected(self) -> DataFrame:
        return self.read("rejected", HOLDING).drop("_place")

    def idf(self) -> DataFrame:
        last = [c for c in self.changes if c["kind"] in ("idf", "compact")][-1:]
        return Snapshot(self.store, last).read("idf", ("idf", "compact")).drop("_place")

    def word_counts(self) -> DataFrame:
        """``(word, document_count)`` from the counts that every change brought, less the hidden postings."""
        counts = self.read("counts", HOLDING).select("word", "document_count")
        if self.deletions is not None:
            lost = document_frequency(self.hidden("postings"))
            counts = counts.unionByName(lost.withColumn("document_count", -F.col("document_count")))
        summed = counts.groupBy("word").agg(F.sum("document_count").alias("document_count"))
        return summed.filter(F.col("document_count") > 0)

    def total_documents(self) -> int:
        held = sum(c["n_documents"] for c in self.changes if c["kind"] in HOLDING)
        if self.deletions is None:
            return held
        return held - self.hidden("documents").filter(F.col("status") == ACCEPTED).count()


class DocumentStore:
    def __init__(
        self, spark: SparkSession, path: str, id_type: str = "string", stored_precision: bool = False
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.stored_precision = stored_precision
        tf_type = "float" if stored_precision else "double"
        self.schemas = {
            "documents": f"doc_id {id_type}, text string, created_at timestamp_ntz, status string",
            "rejected": f"doc_id {id_type}, text string, reason string",
            "postings": f"doc_id {id_type}, word string, word_frequency {tf_type}",
            "counts": "word string, document_count bigint",
            "deletions": f"doc_id {id_type}",
            "idf": "word string, document_count bigint, idf double",
        }

    # -- manifest --------------------------------------------------------------------------------

    def _manifest(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.path}/manifest")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def snapshot(self) -> Snapshot:
        """The changes that no compaction lists; read in one job."""
        manifest = self._manifest()
        if manifest is None:
            return Snapshot(self, [])
        folded = manifest.select(F.explode("folded").alias("_folded"))
        rows = manifest.join(folded, F.col("id") == F.col("_folded"), "left_anti").drop("folded").collect()
        return Snapshot(self, sorted(rows, key=lambda r: (r["number"], r["kind"] != "compact", r["id"])))

    def commits(self) -> list[Row]:
        return self.snapshot().changes

    def made(self, key: str) -> bool:
        """Whether a change with this key is in the manifest."""
        manifest = self._manifest()
        return manifest is not None and not manifest.filter(F.col("key") == key).isEmpty()

    def _publish(
        self, number: int, change: str, kind: str, key: str | None, n_documents: int = 0, folded: list[str] | None = None
    ) -> None:
        entry = self.spark.createDataFrame([(number, change, kind, key, n_documents, folded)], MANIFEST_COLUMNS)
        entry.coalesce(1).withColumn("made_at", F.current_timestamp()).write.mode("append").parquet(
            f"{self.path}/manifest"
        )

    def _next(self) -> int:
        changes = self.snapshot().changes
        return changes[-1]["number"] + 1 if changes else 1

    def _change(self, key: str | None, write: Callable[[str], tuple[str | None, int]]) -> str | None:
        """Lets ``write`` fill a new folder and lists it; None if the key was already used."""
        if key is not None and self.made(key):
            return None
        change = uuid.uuid4().hex
        kind, n_documents = write(change)
        if kind is None:
            return None
        self._publish(self._next(), change, kind, key, n_documents)
        return change

    def _write(self, df: DataFrame, table: str, change: str) -> DataFrame:
        names = T._parse_datatype_string(self.schemas[table]).names
        writer = df.select(*names).write.mode("errorifexists")
        if table == "documents":  # row groups that the tasks of the index read one at a time
            writer = writer.option("parquet.block.size", SORT_SPLIT_BYTES)
        if table in ("documents", "rejected"):  # a look-up by id skips row groups without it
            writer = writer.option("parquet.bloom.filter.enabled#doc_id", "true")
            writer = writer.option("parquet.bloom.filter.expected.ndv#doc_id", BLOOM_IDS)
        writer.parquet(f"{self.path}/changes/{change}/{table}")
        return self.open(table, change)

    def open(self, table: str, change: str) -> DataFrame:
        return self.spark.read.schema(self.schemas[table]).parquet(f"{self.path}/changes/{change}/{table}")

    # -- reading ---------------------------------------------------------------------------------

    def documents(self) -> DataFrame:
        return self.snapshot().documents()

    def postings(self) -> DataFrame:
        return self.snapshot().postings()

    def rejected(self) -> DataFrame:
        """``(doc_id, text, reason)`` of everything that was handed in and not stored."""
        return self.snapshot().rejected()

    def idf(self, as_of: str | datetime | None = None) -> DataFrame:
        """The newest snapshot, which may be older than the postings; or that of an id (as ``refresh_idf``
        returned it), or the last one made up to a time. Without such a snapshot it is empty."""
        if as_of is None:
            return self.snapshot().idf()
        listed = self.idf_snapshots()
        chosen = F.col("snapshot_id") == as_of if isinstance(as_of, str) else F.col("computed_at") <= F.lit(as_of)
        last = listed.filter(chosen).orderBy(F.desc("number"), F.desc("computed_at"), F.desc("snapshot_id")).first()
        if last is None:
            return self.spark.createDataFrame([], self.schemas["idf"])
        return self.open("idf", last["snapshot_id"])

    def idf_snapshots(self) -> DataFrame:
        """``(snapshot_id, number, computed_at)`` of all IDF snapshots ever made."""
        manifest = self._manifest()
        if manifest is None:
            manifest = self.spark.createDataFrame([], MANIFEST_SCHEMA)
        return manifest.filter("kind = 'idf'").select(
            F.col("id").alias("snapshot_id"), "number", F.col("made_at").alias("computed_at")
        )

    def get(self, doc_id: Any) -> DataFrame:
        return get_document(self.documents(), doc_id)

    def get_many(self, ids: DataFrame) -> DataFrame:
        return get_documents(self.documents(), ids)

    # -- changes ---------------------------------------------------------------------------------

    def _fill(
        self, change: str, docs: DataFrame, replace: bool, deleted: DataFrame | None = None, unique: bool = False
    ) -> tuple[str, int]:
        """Writes ``docs (doc_id, text, status)`` with all that is derived from them.

        With ``replace`` the ids of the accepted ones are recorded as deleted, whether or not they exist; the
        next compaction drops these rows. ``deleted`` are further ids to delete. With ``unique`` a repeated id is
        an error; only ids are moved to find it.
        """
        stamped = docs.select("doc_id", "text", F.current_timestamp().cast("timestamp_ntz").alias("created_at"), "status")
        # Ids are fixed by writing the documents before anything is derived from them; they are counted on the way.
        counted = Observation()
        n_accepted = F.count(F.when(F.col("status") == ACCEPTED, 1)).alias("accepted")
        written = self._write(stamped.observe(counted, n_accepted), "documents", change)
        if unique:
            repeated = written.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
            complaint = F.concat(F.lit("several rows and no order for id "), F.col("doc_id").cast("string"))
            repeated.select(F.raise_error(complaint).cast("string")).collect()
        self._write(
            written.filter(F.col("status") != ACCEPTED).withColumnRenamed("status", "reason"), "rejected", change
        )
        accepted = written.filter(F.col("status") == ACCEPTED)
        index = build_index(accepted, stored_precision=self.stored_precision)
        # Sorted files let the scan of a search skip to the pages of its words.
        with small_splits(self.spark):
            postings = self._write(index.sortWithinPartitions("word", F.desc("word_frequency")), "postings", change)
        self._write(document_frequency(postings), "counts", change)
        if replace or deleted is not None:
            ids = accepted.select("doc_id") if replace else self.open("documents", change).limit(0).select("doc_id")
            self._write(ids if deleted is None else ids.unionByName(deleted.select("doc_id")), "deletions", change)
        return "replace" if replace or deleted is not None else "append", counted.get["accepted"]

    @staticmethod
    def _judged(docs: DataFrame) -> DataFrame:
        text = F.coalesce("text", F.lit(""))
        flagged = with_token_flag(docs.withColumn("text", text))
        status = F.when(F.col("doc_id").isNull(), NO_ID).when(F.col("has_tokens"), ACCEPTED).otherwise(NO_TOKENS)
        return flagged.withColumn("status", status)

    def insert(self, texts: DataFrame, key: str | None = None) -> str | None:
        """Store texts under new ids. Equal texts give different documents; texts without tokens
        end up in ``rejected``. Returns the id of the change, None if ``key`` was already used."""
        keyed = texts.select(F.expr("uuid()").alias("doc_id"), "text")
        return self._change(key, lambda change: self._fill(change, self._judged(keyed), False))

    def insert_json(self, bodies: DataFrame, key: str | None = None) -> str | None:
        """Store a set of JSON bodies; those that cannot be stored are kept in ``rejected`` with the reason."""
        decoded = decode_documents(bodies)
        text = F.when(F.col("status").isin(ACCEPTED, NO_TOKENS), F.col("text")).otherwise(F.col("body"))
        keyed = decoded.select(F.expr("uuid()").alias("doc_id"), text.alias("text"), "status")
        return self._change(key, lambda change: self._fill(change, keyed, False))

    def append(self, docs: DataFrame, key: str | None = None) -> str | None:
        """Store documents under their own ids, which must be unique and new to the store."""
        return self._change(key, lambda change: self._fill(change, self._judged(docs), False))

    def upsert(self, docs: DataFrame, key: str | None = None, order_col: str | None = None) -> str | None:
        """Store documents under their own ids, replacing earlier versions as a whole.

        Of several rows with one id the last by ``order_col`` counts; without it, repeated ids are an error.
        A document without tokens is rejected and leaves its earlier version as it is; rows without an id are
        rejected.
        """
        rows = docs.select("doc_id", "text")
        if order_col:
            nameless, named = docs.filter("doc_id IS NULL"), docs.filter("doc_id IS NOT NULL")
            last = named.groupBy("doc_id").agg(F.max_by("text", order_col).alias("text"))
            rows = last.select("doc_id", "text").unionByName(nameless.select("doc_id", "text"))
        unique = order_col is None
        return self._change(key, lambda change: self._fill(change, self._judged(rows), True, unique=unique))

    def apply_changes(self, changes: DataFrame, key: str | None = None) -> str | None:
        """Apply ``(doc_id, text, op, seq)`` rows, ``op`` being ``upsert`` or ``delete``; per id the
        operation with the highest ``seq`` counts. Any other ``op`` is an error and nothing is applied; an
        upsert without an id is rejected."""
        complaint = F.raise_error(F.concat(F.lit("unknown operation: "), F.coalesce("op", F.lit("null"))))
        known = F.when(F.col("op").isin("upsert", "delete"), F.col("op")).otherwise(complaint.cast("string"))
        judged = changes.withColumn("op", known)
        last = judged.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.struct("seq", "op", "text")).alias("_last"))
        latest = last.select("doc_id", "_last.op", "_last.text")
        latest = latest.unionByName(judged.filter("doc_id IS NULL").select("doc_id", "op", "text"))
        kept, gone = latest.filter("op = 'upsert'").select("doc_id", "text"), latest.filter("op = 'delete'")
        return self._change(key, lambda change: self._fill(change, self._judged(kept), True, gone))

    def delete(self, ids: DataFrame, key: str | None = None) -> int:
        """Delete documents with their postings; returns how many existed."""
        found = {"n": 0}

        def write(change: str) -> tuple[str | None, int]:
            held = self.documents().select("doc_id").join(ids.select("doc_id"), "doc_id", "left_semi")
            found["n"] = self._write(held, "deletions", change).count()
            return "delete" if found["n"] else None, 0

        self._change(key, write)
        return found["n"]

    def inserted(self, change: str) -> DataFrame:
        """``(doc_id)`` of the documents of one change."""
        return self.open("documents", change).filter(F.col("status") == ACCEPTED).select("doc_id")

    def compact(self) -> str | None:
        """Rewrite documents by id and postings by word, dropping what deletions hide; rejects are kept.

        Ranges split on a second column too, so one frequent word spreads over several files. Others may write
        meanwhile: only the changes that were read here are left out later on. One compaction at a time.
        """
        seen = self.snapshot()
        if seen.changes:
            change = uuid.uuid4().hex
            n_documents = self._compacted(seen, change)
            folded = [c["id"] for c in seen.changes]
            self._publish(seen.changes[-1]["number"], change, "compact", None, n_documents, folded)
            return change
        return None

    def _compacted(self, seen: Snapshot, change: str) -> int:
        """Fills the folder of a compaction; returns the number of documents."""
        counted = Observation()
        documents = seen.documents().withColumn("status", F.lit(ACCEPTED)).repartitionByRange("doc_id")
        ordered = documents.sortWithinPartitions("doc_id").observe(counted, F.count(F.lit(1)).alias("n"))
        self._write(ordered, "documents", change)
        order = ["word", F.desc("word_frequency"), "doc_id"]
        # Counted from the rows as they lie now, by word: what deletions hide is not looked up a second time.
        postings = seen.postings().repartitionByRange(*order).sortWithinPartitions(*order)
        counts = document_frequency(self._write(postings, "postings", change))
        for table, rows in (("rejected", seen.rejected()), ("counts", counts), ("idf", seen.idf())):
            self._write(rows, table, change)
        return counted.get["n"]

    def refresh_idf(self, retain_missing: bool = False, key: str | None = None) -> str | None:
        """Write a new IDF snapshot; counts and total come from one snapshot of the store.

        The counts are sums of what each change recorded, less the postings that deletions hide, so
        the postings are not counted again. ``retain_missing`` keeps the last value of words that no
        document has any more.
        """

        def write(change: str) -> tuple[str, int]:
            seen = self.snapshot()
            fresh = idf_snapshot(seen.word_counts(), F.lit(seen.total_documents()))
            self._write(merge_idf(seen.idf(), fresh) if retain_missing else fresh, "idf", change)
            return "idf", 0

        return self._change(key, write)

    # -- search ----------------------------------------------------------------------------------

    def search(
        self, query: str, k: int = DEFAULT_K, dedupe_query_terms: bool = False, as_of: str | datetime | None = None
    ) -> DataFrame:
        """``(doc_id, score, text)``, best first, from one snapshot; ``as_of`` chooses an earlier IDF (see ``idf``)."""
        seen = self.snapshot()
        idf = seen.idf() if as_of is None else self.idf(as_of)
        return search(query, seen.postings(), idf, seen.documents(), k, dedupe_query_terms)

    def batch_search(
        self,
        queries: DataFrame,
        k: int = DEFAULT_K,
        with_text: bool = True,
        as_of: str | datetime | None = None,
        **options: Any,
    ) -> DataFrame:
        seen = self.snapshot()
        documents = seen.documents() if with_text else None
        idf = seen.idf() if as_of is None else self.idf(as_of)
        return batch_search(queries, seen.postings(), idf, documents, k, **options)

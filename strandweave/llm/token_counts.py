"""Token counts as rollups that signed deltas maintain.

A ledger holds additive totals (documents, tokens) by source, language and tokenizer version, as versions. A batch of
signed deltas (inserts add, deletes subtract, revised counts do both) is aggregated by Spark and added to the newest
totals; the sums and the batch's id are committed together as the next version. Committing an id again, after a retry or
a lost driver, changes nothing. The ids of all batches are kept in files that are never changed: a commit adds one with its
own id, and ``MERGED`` files of like size become one, so that a version lists a few files (their number grows with the
logarithm of the number of batches) and a commit rewrites few ids. Looking an id up reads these files; reading the totals
doesn't. Of versions and files of ids, those of the newest two versions are kept. Groups whose documents are all gone drop out.

Null texts have no tokens. Null sources and languages are groups of their own. Rows are counted as they come, with or
without a doc_id: a batch that names a document twice counts it twice. An empty batch is committed like any other. Other
columns are ignored and may have any name. A text has to fit into a task. An empty table has no totals.

Tokenizers other than ``WORDS`` need the package ``tiktoken`` and a file of ranks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, scratch_dir, written
from .store import Conflict, commit, newest, remove, stage, version_path

KEYS = ("source", "lang", "tokenizer")
WORDS = "words-1"
#: Fixed value: how the public byte-level vocabularies split a text.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def public_vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@lru_cache(8)
def _encoding(path: str):
    import base64

    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(docs: DataFrame, vocabularies: Mapping[str, str], mark: Column | None = None) -> DataFrame:
    """(doc_id, source, lang, tokenizer, n_tokens, mark) for each row and tokenizer version, over whole texts.

    ``mark``: a boolean that each row keeps (else null). ``vocabularies``: files of ranks by version name, at the same path on all executors. ``WORDS`` is always counted.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encodings = {version: _encoding(path) for version, path in vocabularies.items()}
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                texts = [x.as_py() or "" for x in part.column(3)]
                counts = {WORDS: [len(x.encode().split()) for x in texts]}
                counts |= {version: [len(e.encode_ordinary(x)) for x in texts] for version, e in encodings.items()}
                for version, n in counts.items():
                    yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([version] * len(n)), pa.array(n, pa.int64()), part.column(4)], names=["doc_id", "source", "lang", "tokenizer", "n_tokens", "mark"])

    rows = docs.select(F.col("doc_id").cast("long"), "source", "lang", "text", (F.lit(None) if mark is None else mark).cast("boolean").alias("mark"))
    return rows.mapInArrow(of, "doc_id long, source string, lang string, tokenizer string, n_tokens long, mark boolean")


def inserted(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(1).alias("docs"), F.col("n_tokens").alias("tokens"))


def deleted(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(-1).alias("docs"), (-F.col("n_tokens")).alias("tokens"))


def revised(before: DataFrame, after: DataFrame) -> DataFrame:
    """Documents move from their old counts, and groups, to the new ones."""
    return deleted(before).unionByName(inserted(after))


#: Totals, and rows that name a file of ids and say how many it holds.
STATE = "source string, lang string, tokenizer string, n_docs long, n_tokens long, ids string, n_ids long"
#: Files of ids of one size class that are merged, and ids in one file of a merged table.
MERGED, IDS_IN_FILE = 8, 1_000_000


def _state(spark: SparkSession, ledger: str, version: int | None = None) -> tuple[int, DataFrame]:
    """A version (else the newest) and its rows."""
    version = newest(spark, f"{ledger}/versions") if version is None else version
    if not version:
        return 0, spark.createDataFrame([], STATE)
    return version, spark.read.schema(STATE).parquet(version_path(f"{ledger}/versions", version))


def _id_files(state: DataFrame) -> list[tuple[str, int]]:
    """The files of ids that a version lists, and how many each holds."""
    return sorted((r["ids"], r["n_ids"]) for r in state.where("ids is not null").select("ids", "n_ids").collect())


def _ids(spark: SparkSession, ledger: str, files: list[tuple[str, int]]) -> DataFrame:
    paths = [f"{ledger}/ids/{name}" for name, _ in files]
    return spark.read.schema("batch_id string").parquet(*paths) if paths else spark.createDataFrame([], "batch_id string")


def _with_id(spark: SparkSession, ledger: str, files: list[tuple[str, int]], own: str) -> list[tuple[str, int]]:
    """The list with the file of the own id, after files of like size have been merged."""
    files = [*files, (own, 1)]
    while True:
        tiers: dict[int, list[tuple[str, int]]] = {}
        for name, n in files:
            tier = 0
            while MERGED ** (tier + 1) <= n:
                tier += 1
            tiers.setdefault(tier, []).append((name, n))
        full = next((x for _, x in sorted(tiers.items()) if len(x) >= MERGED), None)
        if full is None:
            return files
        n, name = sum(k for _, k in full), uuid.uuid4().hex
        stage(_ids(spark, ledger, full), f"{ledger}/ids/{name}", 1 + n // IDS_IN_FILE)
        files = [x for x in files if x not in full] + [(name, n)]


def commit_batch(spark: SparkSession, ledger: str, batch_id: str, deltas: DataFrame, attempts: int = 5) -> bool:
    """Add signed ``deltas(source, lang, tokenizer, docs, tokens)`` to the totals once; False if they hold the batch already.

    The new version has the old totals plus those of the batch, and the batch's id. If other writers commit in between, one
    or many, the batch's totals, which are worked out once, are added to the version that they made.
    """
    if not _ids(spark, ledger, _id_files(_state(spark, ledger)[1])).where(F.col("batch_id") == batch_id).isEmpty():
        return False
    batch = written(deltas.groupBy(*KEYS).agg(F.sum("docs").cast("long").alias("n_docs"), F.sum("tokens").cast("long").alias("n_tokens")), "token-batch")
    own = uuid.uuid4().hex
    stage(spark.createDataFrame([(batch_id,)], "batch_id string"), f"{ledger}/ids/{own}")
    for attempt in range(attempts):
        version, state = _state(spark, ledger)
        files = _id_files(state)
        if not _ids(spark, ledger, files).where(F.col("batch_id") == batch_id).isEmpty():
            break
        after = state.where("ids is null").select(*KEYS, "n_docs", "n_tokens").unionByName(batch)
        after = after.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")
        kept = _with_id(spark, ledger, files, own)
        after = after.unionByName(spark.createDataFrame(kept, "ids string, n_ids long"), allowMissingColumns=True).select(*(c.split()[0] for c in STATE.split(", ")))
        try:
            commit(spark, stage(after, f"{ledger}/staged/{uuid.uuid4().hex}"), f"{ledger}/versions", version)
        except Conflict:
            if attempt + 1 == attempts:
                raise
            continue
        if version > 1:  # readers of the version before may go on with it
            gone = {name for name, _ in _id_files(_state(spark, ledger, version - 1)[1])} - {name for name, _ in [*files, *kept]}
            remove(spark, version_path(f"{ledger}/versions", version - 1))
            for name in gone:
                remove(spark, f"{ledger}/ids/{name}")
        return True
    return False


def totals(spark: SparkSession, ledger: str) -> DataFrame:
    """(source, lang, tokenizer, n_docs, n_tokens) of the newest version."""
    return _state(spark, ledger)[1].where("ids is null").drop("ids", "n_ids")


#: Characters that the cleaned texts of the third batch lack.
SYMBOLS = r"[#*$%&|<>]"


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    """All documents arrive; those labelled toxic are deleted; those of low quality are counted again without symbols.

    The deletes are sent twice, as after a retry.
    """
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    vocabularies = {"byte-bpe-50k-1": public_vocabulary()}
    symbols = F.col("text").rlike(SYMBOLS)
    counts = written(count_tokens(docs, vocabularies, symbols), "token-counts")
    toxic = labels.where("toxic = 1").select("doc_id").distinct()
    low = labels.where("quality = 0").select("doc_id").distinct().join(toxic, "doc_id", "left_anti")
    cleaned = docs.where(symbols).join(low, "doc_id", "left_semi").select(*docs.columns)
    after = count_tokens(cleaned.withColumn("text", F.regexp_replace("text", SYMBOLS, "")), vocabularies)
    before = counts.where("mark").join(low, "doc_id", "left_semi")
    ledger = scratch_dir(spark, "token-ledger")
    commit_batch(spark, ledger, "1-arrivals", inserted(counts))
    for _ in range(2):
        commit_batch(spark, ledger, "2-toxic", deleted(counts.join(toxic, "doc_id", "left_semi")))
    commit_batch(spark, ledger, "3-cleaned", revised(before, after))
    return totals(spark, ledger)

"""Token counts: rollups kept up to date by signed changes.

A change has a sign: an insert adds a document's tokens, a delete takes away what was counted for it, a revision does
both. Changes are added up by source, language and tokenizer version and committed as one batch under a name: the batch is
written aside and moved to its name in one step. A name that is there already is a batch that was committed: committing it
again, by a retry or a second writer, changes nothing. The totals are the sums over all batches; compaction adds them up
into a base that names the batches it holds, which are not read again. vacuum() deletes what the newest base holds and leaves
a mark for each such batch, so that its name stays taken; no reader, compaction or retried commit may be at work meanwhile. The
driver lists names of batches since the last vacuum only. Groups whose documents are all gone stay out of the totals.

Cases: null text has no tokens and no characters but counts as a document; null sources and languages are groups of
their own; rows that repeat are documents each; an empty batch commits (and blocks its name) and changes nothing; an empty
store has empty totals; very long texts are counted whole. Only the named columns of a table are read.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, documents, shared_dir, small
from .sentencepiece_codec import model, public_model

KEYS = ["source", "lang", "version"]
SUMS = ["docs", "tokens", "chars"]
SCHEMA = "source string, lang string, version string, docs long, tokens long, chars long"


@lru_cache(maxsize=4)
def _tiktoken(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(path: str) -> Callable[[list[str]], list[int]]:
    """How many tokens each text has, by the kind of the vocabulary file."""
    if path.endswith(".model"):
        def pieces(texts: list[str]) -> list[int]:
            _, at = model(path).ids(texts)
            return (at[1:] - at[:-1]).tolist()
        return pieces
    if path.endswith(".tiktoken"):
        return lambda texts: [len(_tiktoken(path).encode_ordinary(t)) for t in texts]
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    return lambda texts: [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]


def counted(docs: DataFrame, versions: dict[str, str], text: str = "text") -> DataFrame:
    """One row for each document and version: the columns of docs without the text, version, tokens, chars. versions: name
    to vocabulary file."""
    names = ("version", "tokens", "chars", "_text")
    kept = docs.select(F.col(text).alias("_text"), *[F.col(f"`{c}`") for c in docs.columns if c != text and c not in names])
    schema = T.StructType([*kept.schema.fields[1:], T.StructField("version", T.StringType()), T.StructField("tokens", T.LongType()), T.StructField("chars", T.LongType())])

    def run(batches):
        counters = {name: count_tokens(path) for name, path in versions.items()}
        for batch in small(batches):
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for name, count in counters.items():
                cols = [pa.array([name] * len(texts)), pa.array(count(texts), pa.int64()), pa.array(list(map(len, texts)), pa.int64())]
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], *cols], names=schema.names)

    return kept.mapInArrow(run, schema)


def inserts(rows: DataFrame) -> DataFrame:
    """rows: source, lang, version, tokens, chars."""
    return rows.select(*KEYS, F.lit(1).cast("long").alias("sign"), "tokens", "chars")


def deletes(rows: DataFrame) -> DataFrame:
    """rows: what was counted."""
    return rows.select(*KEYS, F.lit(-1).cast("long").alias("sign"), "tokens", "chars")


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    return deletes(old).unionByName(inserts(new))


class TokenRollup:
    """Totals at a path that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return sorted(x.getPath().getName() for x in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _move(self, source: str, to: str) -> bool:
        """In one step; False if the name is taken."""
        self._fs.mkdirs(self._at(to).getParent())
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(self._fs.makeQualified(self._at(source)), self._fs.makeQualified(self._at(to)), none)
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in str(e.java_exception) or self._fs.exists(self._at(to)):
                self._fs.delete(self._at(source), True)
                return False
            raise

    def batches(self) -> list[str]:
        return self._names("batches")

    def _base(self) -> tuple[int, set[str]]:
        """(the newest base's number, -1 if there is none; the batches it holds that were not vacuumed before it was made)."""
        bases = self._names("base")
        if not bases:
            return -1, set()
        held = self.spark.read.schema("batch string").parquet(f"{self.path}/base/{bases[-1]}/held").collect()
        return int(bases[-1]), {r[0] for r in held}

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Adds a batch of signed changes; False (and no change) if it was committed before."""
        if any(self._fs.exists(self._at(f"{x}/{batch}")) for x in ("batches", "vacuumed")):
            return False
        sums = changes.groupBy(*KEYS).agg(F.sum("sign").alias("docs"), F.sum(F.col("sign") * F.col("tokens")).alias("tokens"), F.sum(F.col("sign") * F.col("chars")).alias("chars"))
        aside = f"aside/{uuid.uuid4().hex}"
        sums.write.parquet(f"{self.path}/{aside}")
        return self._move(aside, f"batches/{batch}")

    def _sums(self, number: int, held: set[str], batches: list[str]) -> DataFrame:
        paths = [*([f"{self.path}/base/{number:09d}/sums"] if number >= 0 else []), *(f"{self.path}/batches/{b}" for b in batches if b not in held)]
        rows = self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)
        return rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])

    def totals(self) -> DataFrame:
        return self._sums(*self._base(), self.batches()).where("docs <> 0 or tokens <> 0 or chars <> 0")

    def compact(self) -> bool:
        """A new base of the batches that are committed now; batches committed meanwhile stay beside it. The old files stay until
        vacuum(). False (and no change) if another compaction came first."""
        (number, held), batches = self._base(), self.batches()
        aside = f"aside/{uuid.uuid4().hex}"
        self._sums(number, held, batches).write.parquet(f"{self.path}/{aside}/sums")
        self.spark.createDataFrame([(x,) for x in batches], "batch string").write.parquet(f"{self.path}/{aside}/held")
        return self._move(aside, f"base/{number + 1:09d}")

    def vacuum(self) -> None:
        """Deletes what the newest base holds."""
        bases, held = self._names("base"), self._base()[1]
        for x in bases[:-1]:
            self._fs.delete(self._at(f"base/{x}"), True)
        for x in held.intersection(self.batches()):
            self._fs.mkdirs(self._at(f"vacuumed/{x}"))
            self._fs.delete(self._at(f"batches/{x}"), True)


def changes_of(docs: DataFrame, labels: DataFrame, versions: dict[str, str], scratch: Scratch) -> dict[str, DataFrame]:
    """The signed changes of the registered query, by batch: all documents in, those with repeated lines revised to have each
    line once, those labelled bad out. A revised document's old and new counts come from the same row, so null and shared ids do
    no harm; a label strikes every row with its id, and null ids have no label."""
    once = F.array_join(F.array_distinct(F.split("text", "\n", -1)), "\n")
    rows = docs.select("doc_id", "source", "lang", "text", F.coalesce(once != F.col("text"), F.lit(False)).alias("revised"))
    first = scratch.keep(counted(rows, versions))
    second = scratch.keep(counted(rows.where("revised").withColumn("text", once), versions))
    bad = labels.where("quality = 0").select("doc_id").distinct()
    now = first.where("not revised").unionByName(second)
    return {"load": inserts(first), "revise": revisions(first.where("revised"), second), "retire": deletes(now.join(bad, "doc_id", "left_semi"))}


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    """Totals after all changes, by source, language and each of two tokenizers; the revision is committed twice."""
    import public_tokenizers

    scratch = Scratch(spark)
    versions = {"piece_bpe_32k": public_model(), "byte_bpe_50k": public_tokenizers.path("byte_bpe_50k.tiktoken")}
    changes = changes_of(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), versions, scratch)
    rollup = TokenRollup(spark, f"{shared_dir(spark)}/talkmill/rollup-{uuid.uuid4().hex}")
    rollup.commit("load", changes["load"])
    rollup.commit("revise", changes["revise"])
    rollup.commit("revise", changes["revise"])
    rollup.compact()
    rollup.commit("retire", changes["retire"])
    scratch.clear()
    return rollup.totals()

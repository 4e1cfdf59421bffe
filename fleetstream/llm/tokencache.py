"""Token counts through a digest cache.

The cache is a table of (content digest, tokenizer version, tokens).  Texts are digested
where they are read; the distinct ones that the cache lacks are encoded by the tokenizer's
library and appended; then every document is joined to its count.  Normalised content is
the UTF-8 text as the library gets it, null as empty; the version is the digest of the
tokenizer's file, so another file never meets old counts.

Copies are dropped inside each task before the shuffle, so a text that a third of all rows
share reaches its partition once per task.  In a worker, counts of the pieces between
single spaces are kept in a bounded memory where the tokenizer splits there by itself
(byte-level with its regular expression and without a normaliser); other tokenizers get
whole texts.  A task encodes in one thread: the tasks fill the cores already.

Defined cases: null and empty texts have no tokens; null ids are kept; repeated rows get
equal counts; special strings inside a text are handled as the library does by default; a
cache with a digest twice (an append that was run again) is read once; other columns are
ignored; an empty table gives an empty result; long texts are counted whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstream.session import fresh_path

CACHE_SCHEMA = "digest binary, version string, n_tokens bigint"
# Pieces whose counts a worker remembers, and texts encoded at a time.
PIECES = 400_000
ENCODE_CHARS = 1 << 18

# A space starts a new piece if what stands before it is not white space.
_JOINED = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


class Counter:
    """Token counts of texts by one tokenizer file."""

    def __init__(self, path: str):
        self.known: dict[str, int] = {}
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.lengths = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            self.special: list[str] = []
            self.splits = False
            return
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.lengths = lambda texts: [
            len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ]
        config = json.loads(Path(path).read_text(encoding="utf-8"))
        before = config.get("pre_tokenizer") or {}
        self.special = [x["content"] for x in config.get("added_tokens", [])]
        self.splits = (
            config.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space", True)
        )

    def pieces(self, text: str) -> list[str]:
        """The text cut before single spaces, where the tokenizer cuts as well."""
        if _JOINED.search(text):
            return _CUT.split(text)
        first, *rest = text.split(" ")
        return [first, *(" " + x for x in rest)]

    def encode(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= ENCODE_CHARS):
                size += len(texts[end])
                end += 1
            out += self.lengths(texts[at:end])
            at = end
        return out

    def count(self, texts: list[str]) -> list[int]:
        if not self.splits:
            return self.encode(texts)
        return [self._by_pieces(t) for t in texts]

    def _by_pieces(self, text: str) -> int:
        if any(s in text for s in self.special):
            return self.encode([text])[0]
        pieces = self.pieces(text)
        known = self.known
        missing = list({p for p in pieces if p not in known})
        if missing:
            if len(known) > PIECES:
                known.clear()
                missing = list(set(pieces))
            known.update(zip(missing, self.encode(missing), strict=True))
        return sum(map(known.__getitem__, pieces))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def version_of(path: str) -> str:
    """The digest of a tokenizer's file."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _once_per_task(batches):
    """Drops texts that the task has passed on already."""
    seen: set[bytes] = set()
    for batch in batches:
        fresh = []
        for i, d in enumerate(batch.column("digest").to_pylist()):
            if d not in seen:
                seen.add(d)
                fresh.append(i)
        yield batch.take(pa.array(fresh, pa.int64()))


def _counted(path: str, version: str):
    def run(batches):
        # The library's own threads, by default on all cores in each worker, only add CPU time.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        seen: set[bytes] = set()
        for batch in batches:
            digests, texts = [], []
            for d, t in zip(batch.column("digest").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if d not in seen:
                    seen.add(d)
                    digests.append(d)
                    texts.append(t)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(digests, pa.binary()),
                    pa.array([version] * len(digests), pa.string()),
                    pa.array(counter(path).count(texts), pa.int64()),
                ],
                ["digest", "version", "n_tokens"],
            )

    return run


def exists(spark, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def encode_misses(docs: DataFrame, tokenizer: str, cache: str) -> None:
    """Encode the distinct texts that the cache lacks and append their counts."""
    spark, version = docs.sparkSession, version_of(tokenizer)
    texts = docs.select(digest(F.col("text")).alias("digest"), F.coalesce("text", F.lit("")).alias("text"))
    local = texts.mapInArrow(_once_per_task, texts.schema).repartition("digest")
    if exists(spark, cache):
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("version") == version)
        local = local.join(stored.select("digest"), "digest", "left_anti")
    local.mapInArrow(_counted(tokenizer, version), CACHE_SCHEMA).write.mode("append").parquet(cache)


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``; without a ``cache`` one is begun for this call."""
    spark = docs.sparkSession
    cache = cache or fresh_path(spark, "token-cache")
    encode_misses(docs, tokenizer, cache)
    counts = (
        spark.read.schema(CACHE_SCHEMA)
        .parquet(cache)
        .where(F.col("version") == version_of(tokenizer))
        .groupBy("digest")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )
    narrow = docs.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"),
        digest(F.col("text")).alias("digest"),
    )
    return narrow.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )

"""Token counts (operator 1) by a map-side two-tier look-up.

A pre-token's length in tokens depends on the pre-token alone. Tier one is a broadcast table of
frequent pre-tokens and their lengths, of at most ``table_size`` entries of at most ``LONGEST``
characters (so its size is bounded); tier two is each worker's cache of the misses it has encoded.
Pre-tokens are never shuffled. The table only saves encoding: counts don't depend on what is in
it, so it may be fitted on a bounded sample of documents (``sample_docs``), whole texts.

A text that holds a special token's string, or a character on which the two implementations of the
split pattern could differ, is encoded whole by the library instead, with its defaults.

Defined results: the digests ignore other columns, whatever their
names, and filters return all of them; a null text is empty (0 bytes, 0 tokens); a null doc_id is passed through; rows
that repeat are counted each; an empty table gives no rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm._frames import doc_texts

# Fixed value: the split pattern of the tokenizer files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Characters on which the library's split and this pattern are checked (by a test) to agree:
# ASCII without rarely used controls, Latin, Greek and Cyrillic letters, common punctuation.
PLAIN = r"[\t\n\r\x20-\x7e¡-¬®-ͷ΄-ΊΎ-ΡΣ-ԯ‐-‧‰-⁞₠-₿]*"
MAX_TOKENS = 512     # over_limit beyond so many
TABLE_SIZE = 50_000  # entries of the broadcast table
LONGEST = 32         # characters of a pre-token that is kept in the table or a cache
SAMPLE_DOCS = 2_000  # size of the sample the table is fitted on
CACHE_SIZE = 400_000 # entries of a worker's cache, which then starts anew

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


class Encoder:
    """A worker's tokenizer, its split pattern, and the two tiers."""

    def __init__(self, content: str, frequent: dict[str, int]):
        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = regex.compile(PATTERN).findall
        self.plain = regex.compile(PLAIN).fullmatch
        self.frequent, self.lengths = frequent, dict(frequent)

    def encode(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def by_parts(self, text: str) -> bool:
        return self.plain(text) is not None and not any(s in text for s in self.special)

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.by_parts(text):
            return self.encode(text)
        parts, look = self.split(text), self.lengths.get
        found = list(map(look, parts))
        if None in found:
            for k, n in enumerate(found):
                if n is None:
                    # one pre-token is encoded by itself exactly as it is inside its text
                    found[k] = n = look(parts[k]) or self.encode(parts[k])
                    if len(parts[k]) <= LONGEST:
                        self.lengths[parts[k]] = n
            if len(self.lengths) > CACHE_SIZE + len(self.frequent):
                self.lengths = dict(self.frequent)
        return sum(found)


def encoder(shared: dict) -> Encoder:
    """One per worker process: it lives on the broadcast value, which tasks of a worker share."""
    if "encoder" not in shared:
        shared["encoder"] = Encoder(shared["content"], shared["frequent"])
    return shared["encoder"]


def frequent_pretokens(docs: DataFrame, content, sample_docs: int, table_size: int) -> dict[str, int]:
    """The most frequent pre-tokens of a sample of about ``sample_docs`` documents (those whose
    hash of doc_id falls below that share of all hashes), and their lengths."""
    texts = doc_texts(docs)
    share = min(1.0, sample_docs / max(1, texts.count()))
    sample = texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) <= int(share * (1 << 30)))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seen = encoder(content.value), Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text and enc.by_parts(text):
                    seen.update(p for p in enc.split(text) if len(p) <= LONGEST)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["part", "n"])

    tallied = sample.mapInArrow(tally, "part string, n bigint").groupBy("part").agg(F.sum("n").alias("n"))
    top = tallied.orderBy(F.desc("n"), "part").limit(table_size).select("part")

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(content.value)
        for batch in batches:
            n = pa.array([enc.encode(p) for p in batch.column("part").to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("part"), n], names=["part", "n"])

    rows = top.mapInArrow(lengths, "part string, n int").toArrow()
    return dict(zip(rows.column("part").to_pylist(), rows.column("n").to_pylist(), strict=True))


def token_counts(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS,
                 table_size: int = TABLE_SIZE, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every document. The tokenizer file (a small
    file of fixed size) is read on the driver and broadcast, so executors need no copy of it."""
    sc = docs.sparkSession.sparkContext
    with open(tokenizer_path, encoding="utf-8") as f:
        content = f.read()
    frequent = frequent_pretokens(docs, sc.broadcast({"content": content, "frequent": {}}), sample_docs, table_size)
    shared = sc.broadcast({"content": content, "frequent": frequent})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value)
        for batch in batches:
            texts = batch.column("text")
            n = [enc.count(t) if t else 0 for t in texts.to_pylist()]
            size = pc.cast(pc.fill_null(pc.binary_length(texts), 0), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, pa.array(n, pa.int64()), pa.array([x > max_tokens for x in n], pa.bool_())],
                                             names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return doc_texts(docs).mapInArrow(count, SCHEMA)

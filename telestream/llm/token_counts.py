"""Token counts through a digest cache.

Texts are keyed by a digest of their normalised content and one of the tokenizer: its file
and the library's version. Normalised content is what the tokenizer itself makes of a text
before it cuts it (nothing else would leave counts alone): the text where its file names no
normaliser, else the normaliser's output. Counts that the cache holds are joined; of the
rest each distinct content is encoded once and its count is appended to the cache. Only
digests, row numbers and counts are shuffled by key; the texts move once, to meet the rows
that were picked to be encoded. The cache is stored by tokenizer, so that one call reads
the counts of its own only, and it is read and joined once.

A null text counts as empty. Rows with a null or repeated id, repeated rows and extra
columns are carried through row by row. Counts that the cache holds twice (of calls that
ran at a time, or a repeated task) are equal, and one is taken. An empty table gives an
empty result and leaves the cache as it was.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..packaging import ship
from .common import Workspace, map_rows, shared_dir

CACHE = "digest string, n_tokens long"
#: The pattern of byte-level pieces (fixed by the format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A space beside other white space: there a run may be cut differently than chunk by chunk.
_RUN = re.compile(r" \s|\s ")
_counters: dict[str, Callable[[str], int]] = {}
_normalisers: dict[str, Callable[[str], bytes]] = {}


def library(path: str) -> tuple[str, str]:
    """The library that defines a file's counts, and its version."""
    import sentencepiece
    import tokenizers

    return ("sentencepiece", sentencepiece.__version__) if path.endswith(".model") else ("tokenizers", tokenizers.__version__)


def version(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + repr(library(path)).encode()).hexdigest()[:32]


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def is_plain(spec: dict) -> bool:
    """Whether a file says no more than what ``_byte_level`` does: byte-level pieces by the
    fixed pattern, merges in the order of their numbers, whole special strings."""
    model, pre, post = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("post_processor") or {"type": "ByteLevel"}
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or post.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        return False
    if model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")):
        return False
    if any(t.get(k) for t in spec.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word", "normalized")):
        return False
    vocab, special = model["vocab"], {t["content"] for t in spec.get("added_tokens", [])}
    merged = ["".join(m if isinstance(m, list) else m.split(" ", 1)) for m in model["merges"]]
    places = [vocab.get(x, -1) for x in merged]
    single = {t for t in vocab if len(t) == 1}
    return len(single & set(_byte_of())) == 256 and all(a < b for a, b in zip(places, places[1:])) and min(places, default=0) >= 0 and set(vocab) - special <= single | set(merged)


def _byte_level(spec: dict) -> Callable[[str], int]:
    import tiktoken

    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    byte = _byte_of()
    ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    coder = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    whole = lambda t: len(coder.encode(t, allowed_special="all"))
    known: dict[str, int] = {}

    def count(text: str) -> int:
        # no token spans a chunk that starts at a single space, so chunks are counted once each
        if _RUN.search(text) or any(s in text for s in special):
            return whole(text)
        chunks = text.split(" ")
        total = len(coder.encode_ordinary(chunks[0]))
        try:
            return total + sum(map(known.__getitem__, chunks[1:]))
        except KeyError:
            if len(known) > 300_000:
                known.clear()
            for c in chunks[1:]:
                if c not in known:
                    known[c] = len(coder.encode_ordinary(" " + c))
            return total + sum(map(known.__getitem__, chunks[1:]))

    return count


def normaliser(path: str) -> Callable[[str], bytes] | None:
    """The normalised content of a text, which settles its count; None for the text itself.

    A text that holds a special string as it stands is its own content, for such strings
    are looked for before a text is normalised."""
    if path.endswith(".model"):
        import sentencepiece

        coder = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda t: coder.normalize(t).encode()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if not spec.get("normalizer"):
        return None
    from tokenizers import Tokenizer

    special = [t["content"] for t in spec.get("added_tokens", [])]
    tool = Tokenizer.from_file(path).normalizer
    return lambda t: b"\0" + t.encode() if any(x in t for x in special) else tool.normalize_str(t).encode()


def counter(path: str) -> Callable[[str], int]:
    """A function that counts tokens as the file's library does; one per Python worker.

    Plain byte-level vocabularies (``is_plain``) are counted by an equivalent, faster coder
    (a test holds it against the library); all others by the library itself.
    """
    if path not in _counters:
        if path.endswith(".model"):
            import sentencepiece

            coder = sentencepiece.SentencePieceProcessor(model_file=path)
            _counters[path] = lambda t: len(coder.encode(t))
        else:
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            if is_plain(spec):
                _counters[path] = _byte_level(spec)
            else:
                from tokenizers import Tokenizer

                t = Tokenizer.from_file(path)
                t.no_padding(), t.no_truncation()
                _counters[path] = lambda x: len(t.encode(x, add_special_tokens=False).ids)
    return _counters[path]


def content(tokenizer: str) -> Column:
    """The normalised content of ``text`` in bytes."""
    if normaliser(tokenizer) is None:
        return F.col("text").cast("binary")

    def run(text: pa.Array) -> pa.Array:
        if tokenizer not in _normalisers:
            _normalisers[tokenizer] = normaliser(tokenizer)
        return pa.array([_normalisers[tokenizer](t) for t in text.to_pylist()], pa.binary())

    return F.arrow_udf(run, "binary")(F.col("text"))


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; ``cache``: the folder of stored
    counts, to which this call appends (by default a new one for this call)."""
    spark: SparkSession = docs.sparkSession
    ws = Workspace(spark, "token-counts")
    ship(spark)
    cache, tag = cache or f"{ws.path}/cache", version(tokenizer)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", F.sha2(content(tokenizer), 256))
    keyed = ws.table(rows.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "keys")
    # no folder yet, or one without files, means that nothing is stored
    own = f"{cache}/tokenizer={tag}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(own)
    exists = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    stored = spark.read.schema(CACHE).parquet(own) if exists else spark.createDataFrame([], CACHE)
    # a digest of which copies are many is one row before it meets the cache
    picked = keyed.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count("doc_id").alias("ids")).join(stored, "digest", "left")
    picked = ws.table(picked.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.min("ids").alias("ids"), F.max("n_tokens").alias("n_tokens")), "picked")
    misses = picked.filter("n_tokens IS NULL")
    chosen = misses.filter("ids > 0").select("doc_id", F.col("digest").alias("want"))
    # an id without a row of its own (all null) is looked up by digest instead
    found = rows.join(chosen, "doc_id").filter("digest = want").select("digest", "text")
    unnamed = misses.filter("ids = 0").select("digest")
    found = found.unionByName(rows.filter("doc_id IS NULL").join(unnamed, "digest", "left_semi").select("digest", "text"))

    def encode(b: pa.RecordBatch) -> dict:
        count = counter(tokenizer)
        return {"digest": b.column("digest"), "n_tokens": [count(t) for t in b.column("text").to_pylist()]}

    # an id that stands on a text twice gives its count twice
    new = ws.table(map_rows(found, CACHE, encode, "text").groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "new")
    new.write.mode("append").parquet(own)
    counts = picked.filter("n_tokens IS NOT NULL").select("digest", "n_tokens").unionByName(new)
    out = keyed.join(counts, "digest")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def default_cache(spark: SparkSession) -> str:
    """A cache that outlives the call, in the shared folder."""
    return f"{shared_dir(spark)}/token-count-cache"

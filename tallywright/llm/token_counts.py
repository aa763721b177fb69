"""Token counts of whole texts by a two-tier lookup inside each task.

1. A frequent-items sketch runs over the words of all texts: one sketch of fixed size per task, combined
   in two steps. The sketches travel, pre-tokens never do.
2. The pre-tokens of the words it names get their token counts from the library, once, on the driver. The
   most frequent `ENTRIES` of them are the first tier, a hash table of a few hundred KB that is broadcast.
   Its size is bounded by `ENTRIES` and `LONGEST`, whatever the corpus holds.
3. Every task splits its texts as the tokenizer does, adds up the counts the table knows, and gives the
   other pre-tokens to the library, one call each; the answers stay in a cache of the worker that is
   emptied when it is full (second tier).

Tables and caches change the time, never a count: a missing entry is encoded. The split itself is checked
against the library for every character that a worker meets. Characters for which it differs, those that
combine with their neighbours, and texts that hold one of the added tokens send the whole text through the
library.

Nulls and odd rows: a null text is empty and has 0 tokens; every row is counted by itself, whatever its
doc_id, null and repeated ones too; an empty table gives an empty result. Columns other than
`doc_id, text` are not read.
"""

import os
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from .tasks import ship, whole_text
from .tokens import vocabulary_path

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048

# Words a sketch may track, and entries of the broadcast table.
TRACKED = 1 << 15
ENTRIES = 1 << 14
# Longer words are left to the workers; characters.
LONGEST = 64
# Sketches are combined in so many groups first.
GROUPS = 256
# Pre-tokens a worker remembers besides the table; about 100 bytes each.
REMEMBERED = 500_000

# Fixed: how the vocabulary's file says that texts are split.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")

RESULT = "doc_id long, n_bytes long, n_tokens long"


class Lengths(dict):
    """Pre-token -> number of its tokens: the broadcast table, then what this worker has encoded."""

    def __init__(self, tokenizer, frequent: dict[str, int], remembered: int = REMEMBERED):
        super().__init__(frequent)
        self.tokenizer, self.frequent, self.remembered = tokenizer, frequent, remembered

    def encoded(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, piece: str) -> int:
        found = self.encoded(piece)
        if len(piece) <= LONGEST:
            if len(self) - len(self.frequent) >= self.remembered:
                self.clear()
                self.update(self.frequent)
            self[piece] = found
        return found


class TokenCounter:
    """Counts the tokens of texts, piece by piece where that is what the library does."""

    def __init__(self, path: str, frequent: dict[str, int] | None = None, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.lengths = Lengths(self.tokenizer, frequent or {}, remembered)
        self.plain: set[str] = set()
        self.odd: set[str] = set()

    def _split(self, text: str) -> int:
        normal = self.tokenizer.normalizer.normalize_str(text)
        return len(self.tokenizer.pre_tokenizer.pre_tokenize_str(normal))

    def _as_library(self, letter: str) -> bool:
        """Whether `lower` and PRE_TOKEN do to this character, anywhere, what the library does."""
        if unicodedata.category(letter)[0] == "M" or "ᄀ" <= letter <= "ᇿ" or letter > "힣":
            return False  # may join the character before it
        lowered = letter.lower()
        if not letter.isspace() and self.tokenizer.normalizer.normalize_str(letter) != lowered:
            return False
        # Letters join both neighbours, digits neither, spaces vanish, marks join the mark.
        probes = (f"a{letter}a", f"a{letter}!a", f"a!{letter}a", f"1{letter}1")
        return len(lowered) == 1 and letter != "Σ" and all(  # a capital sigma lowers by its place
            self._split(x) == len(PRE_TOKEN.findall(x.lower())) for x in probes
        )

    def is_plain(self, text: str) -> bool:
        letters = set(text) - self.plain
        for letter in letters - self.odd:
            (self.plain if self._as_library(letter) else self.odd).add(letter)
        return not letters & self.odd

    def count(self, text: str) -> int:
        if any(token in text for token in self.added) or not self.is_plain(text):
            return self.lengths.encoded(text)
        return sum(map(self.lengths.__getitem__, PRE_TOKEN.findall(text.lower())))


_counters: dict[str, TokenCounter] = {}


def worker_counter(path: str, frequent: dict[str, int], remembered: int) -> TokenCounter:
    """This worker's counter for a vocabulary, with what it has encoded in earlier tasks."""
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    lengths = _counters[path].lengths
    if lengths.frequent != frequent or lengths.remembered != remembered:
        lengths.frequent, lengths.remembered = frequent, remembered
        lengths.clear()
        lengths.update(frequent)
    return _counters[path]


def frequent_lengths(docs: DataFrame, path: str, tracked: int = TRACKED, entries: int = ENTRIES) -> dict[str, int]:
    """Token counts of the most frequent pre-tokens, found by sketches over all texts."""
    words = docs.select(F.explode(F.split(F.lower(whole_text()), " ")).alias("word"))
    words = words.filter(F.length("word").between(1, LONGEST))
    task = (F.spark_partition_id() % GROUPS).alias("task")
    sketches = words.groupBy(task).agg(F.expr(f"approx_top_k_accumulate(word, {tracked})").alias("sketch"))
    # One group, and none at all without words: a sketch of nothing cannot be read.
    whole = sketches.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    best = whole.select(F.expr(f"approx_top_k_estimate(sketch, {tracked // 2})")).first()
    counter, seen = TokenCounter(path), Counter()
    for word, count in best[0] if best and best[0] else ():
        if counter.is_plain(word):
            for piece in PRE_TOKEN.findall(word.lower()):
                seen[piece] += count
    return {piece: counter.lengths[piece] for piece, _ in seen.most_common(entries)}


def token_counts(docs: DataFrame, vocabulary: str | None = None, remembered: int = REMEMBERED) -> DataFrame:
    """One row per row of `docs` (doc_id, text): `doc_id, n_bytes` (UTF-8), `n_tokens`."""
    spark = docs.sparkSession
    ship(spark)
    path = vocabulary or vocabulary_path(VOCABULARY)
    frequent = spark.sparkContext.broadcast(frequent_lengths(docs, path))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_counter(path, frequent.value, remembered)
        for batch in batches:
            n = [counter.count(text) for text in batch["text"].to_pylist()]
            columns = [batch["doc_id"], batch["n_bytes"], pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    sized = texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    return sized.mapInArrow(counted, RESULT)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document and whether it is over the limit."""
    counts = token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)

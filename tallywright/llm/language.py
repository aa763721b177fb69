"""Language of web pages by Bayesian evidence fusion.

Four sources of evidence are multiplied, as sums of logarithms:

* text: a multinomial model over byte trigrams of the page's visible text, damped, since neighbouring
  trigrams say the same thing;
* declared markup language: how often a page whose text speaks for language L declares D;
* address suffix: the same for a language code in the path, `/fr/`, and for a country domain;
* host prior: how often pages of this host speak for L, smoothed towards its domain, that towards its
  top-level domain, and that towards all pages.

The counts come from grouped aggregation over all pages, in which each page counts for its text's best
language; the page's own vote is taken out of its host's counts before they are used on it. The text
model is fitted on about `sample` labelled documents, chosen by a hash, and holds 4096 numbers for each
language.

Nulls and odd rows: a null or empty page has no text evidence and is decided by its address, a page
without anything by the overall prior; a null url belongs to the host ""; rows are judged one by one, so
repeats get equal answers; ties go to the first language in alphabetic order; without any labelled
document, or without pages, the result is empty of languages (null) or of rows. Other columns than `html`
are kept; those named like a result (`lang, probability, vote, declared, suffix, host`) are replaced.
"""

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .tasks import ship, staged

SAMPLE = 8_000
BUCKETS = 4096
# Trigrams beyond so many add nothing to a text's log likelihood.
DAMP = 60.0
# Pages that the level above counts for, in each smoothing step.
WEIGHT = 5.0

RESULTS = ("lang", "probability", "vote", "declared", "suffix", "host")

_OPENING = re.compile(r"(?i)<(script|style|nav|footer)\b|<!--")
_CLOSING = re.compile(r"(?i)</(script|style|nav|footer)\s*>|-->")
_TAG = re.compile(r"<[^>]*>")

_CASE = np.array([x + 32 if 65 <= x <= 90 else x for x in range(256)], np.uint8)


def trigram_counts(text: str) -> np.ndarray:
    """Hashed byte trigrams of a text; A-Z lowered, digits and marks as one kind of gap."""
    raw = np.frombuffer(b" " + text.encode() + b" ", np.uint8)
    letters = ((raw | 32) >= 97) & ((raw | 32) <= 122) | (raw >= 128)
    low = np.where(letters, _CASE[raw], 32).astype(np.uint32)
    low = low[np.append(True, (low[1:] != 32) | (low[:-1] != 32))]
    if len(low) < 3:
        return np.zeros(BUCKETS, np.int64)
    codes = (low[:-2] * 65599 + low[1:-1]) * 65599 + low[2:]
    return np.bincount((codes * np.uint32(2654435761)) >> np.uint32(20), minlength=BUCKETS)


def visible(html: str) -> str:
    """Text of a page without scripts, styles, comments, navigation and tags.

    Every closing is found once and looked up by place, so an opening without one costs nothing more.
    """
    closings: dict[str, list[tuple[int, int]]] = {}
    for found in _CLOSING.finditer(html):
        closings.setdefault((found[1] or "").lower(), []).append(found.span())
    parts, at = [], 0
    for found in _OPENING.finditer(html):
        own = closings.get((found[1] or "").lower(), [])
        place = bisect_left(own, (found.end(), 0))
        if found.start() >= at and place < len(own):
            parts.append(html[at : found.start()])
            at = own[place][1]
    html = " ".join([*parts, html[at:]])
    # Behind the last tag's end no tag can end.
    last = html.rfind(">") + 1
    return _TAG.sub(" ", html[:last]) + html[last:]


def fit_text_model(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages and log probability of each bucket under each, from labelled documents."""
    ship(docs.sparkSession)
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    share = sample / max(sample, labelled.count())
    chosen = labelled.filter(F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 20)) < int(share * (1 << 20)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                one = trigram_counts(text.as_py())
                sums[lang.as_py()] = sums.get(lang.as_py(), 0) + one
        for lang, one in sorted(sums.items()):
            kept = np.flatnonzero(one)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(kept)), pa.array(kept, pa.int64()), pa.array(one[kept], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    rows = chosen.select("lang", "text").mapInArrow(count, "lang string, bucket long, n long")
    table = rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    if not len(table):
        return [], np.zeros((0, BUCKETS))
    langs = sorted(table["lang"].unique())
    counts = np.ones((len(langs), BUCKETS))
    for at, lang in enumerate(langs):
        part = table[table["lang"] == lang]
        counts[at, part["bucket"].to_numpy(np.int64)] += part["n"].to_numpy()
    return langs, np.log(counts / counts.sum(1, keepdims=True))


def addresses(pages: DataFrame, langs: list[str]) -> DataFrame:
    """`row`, the columns to keep as `input`, `html`, and what address and markup say of the language."""
    html, url = F.coalesce("html", F.lit("")), F.lower(F.coalesce("url", F.lit("")))
    host = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1)
    tag = F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})\b", 1)
    path = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://[^/]*/(?:[^?#]*/)?([a-z]{2})(?:/|$|[?#])", 1)
    tld = F.regexp_extract(host, r"([^.]*)$", 1)
    kept = [pages[c] for c in pages.columns if c.lower() not in ("html", *RESULTS)]
    return pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*kept, F.lit(0).alias("_tallywright")).alias("input"),
        html.alias("html"),
        host.alias("host"),
        F.regexp_extract(host, r"([^.]*\.[^.]*)$", 1).alias("domain"),
        tld.alias("tld"),
        F.lower(tag).alias("declared"),
        F.when(path.isin(langs) if langs else F.lit(False), path).when(F.length(tld) == 2, tld).otherwise("").alias("suffix"),
    )


def with_input(found: DataFrame) -> DataFrame:
    """The columns of the input, then the results."""
    return found.select("input.*", *RESULTS).drop("_tallywright")


def evidence(pages: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """`addresses` with the text's log likelihoods and its best language; written out without the
    pages' own text."""
    spark = pages.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(model.astype(np.float32))

    @F.pandas_udf("array<double>")
    def likelihood(html):
        import pandas as pd

        out = []
        for one in html:
            counts = trigram_counts(visible(one))
            n = counts.sum()
            logs = model.value @ counts * (min(1.0, DAMP / n) if n else 0.0)
            out.append((logs - logs.max()).tolist())
        return pd.Series(out)

    found = addresses(pages, langs).withColumn("text_logs", likelihood("html"))
    best = F.element_at(F.lit(langs), F.array_position("text_logs", F.lit(0.0)).cast("int"))
    known = F.aggregate("text_logs", F.lit(0.0), lambda a, x: a + x) < 0
    return staged(found.withColumn("vote", F.when(known, best)).drop("html"), "evidence")


def _shares(votes: DataFrame, by: list[str], langs: list[str]) -> DataFrame:
    """Votes for each language per group, as an array in the order of `langs`."""
    counts = F.array(*(F.count_if(F.col("vote") == lang).cast("double") for lang in langs))
    return votes.groupBy(*by).agg(counts.alias(f"_{by[-1]}"))


def fuse(pages: DataFrame, langs: list[str], model: np.ndarray, weight: float = WEIGHT) -> DataFrame:
    """Every page with `lang`, its `probability` and the parts of the evidence that speak for it."""
    if not langs:
        nothing = {"lang": F.lit(None).cast("string"), "probability": F.lit(None).cast("double"), "vote": F.lit(None).cast("string")}
        return with_input(addresses(pages, langs).withColumns(nothing))
    found = evidence(pages, langs, model)
    k = len(langs)
    own = F.transform(F.lit(langs), lambda lang: F.when(F.col("vote") == lang, 1.0).otherwise(0.0))
    zero = F.array(*[F.lit(0.0)] * k)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    smoothed = lambda votes: lambda x: (x["n"] + F.lit(weight) * x["p"]) / (votes + weight)
    overall = found.agg(*(F.count_if(F.col("vote") == lang).cast("double") for lang in langs)).first()
    prior = F.lit([(n + 1) / (sum(overall) + k) for n in overall])

    # One row per level's group: bounded by the number of hosts, looked up by joins of written tables.
    levels = {"tld": ["tld"], "domain": ["tld", "domain"], "host": ["tld", "domain", "host"]}
    fused = found.withColumn("_own", own)
    for name, by in levels.items():
        fused = fused.join(staged(_shares(found, by, langs), f"votes-{name}"), by, "left")
    for name in levels:
        # Without the page's own vote; smoothed towards the level above.
        rest = F.transform(F.arrays_zip(F.coalesce(f"_{name}", zero).alias("n"), F.col("_own").alias("o")), lambda x: x["n"] - x["o"])
        above = prior
        fused = fused.withColumn(f"_{name}", rest)
        prior = F.transform(
            F.arrays_zip(F.col(f"_{name}").alias("n"), above.alias("p")),
            smoothed(total(F.col(f"_{name}"))),
        )
        fused = fused.withColumn(f"_p_{name}", prior)
        prior = F.col(f"_p_{name}")
    # How reliable declarations are, at most (languages declared) rows: a table of codes, not of pages.
    for name in ("declared", "suffix"):
        fused = fused.join(staged(_shares(found.filter(F.col(name) != ""), [name], langs), f"votes-{name}"), [name], "left")
        like = F.transform(
            F.arrays_zip(F.coalesce(f"_{name}", zero).alias("n"), F.lit([float(n) for n in overall]).alias("all"), F.col("_own").alias("o")),
            lambda x: F.log((x["n"] - x["o"] + 0.5) / (x["all"] - x["o"] + 0.5 * (k + 1))),
        )
        fused = fused.withColumn(f"_l_{name}", F.when(F.col(f"_{name}").isNull(), zero).otherwise(like))
    parts = F.arrays_zip(
        F.col("text_logs").alias("t"),
        F.col("_l_declared").alias("d"),
        F.col("_l_suffix").alias("s"),
        F.transform("_p_host", lambda x: F.log(x)).alias("h"),
        F.lit(langs).alias("lang"),
    )
    scored = F.transform(
        parts, lambda x: F.struct((x["t"] + x["d"] + x["s"] + x["h"]).alias("score"), x["lang"].alias("lang"))
    )
    fused = fused.withColumn("_scored", scored)
    top = F.array_max(F.transform("_scored", lambda x: x["score"]))
    fused = fused.withColumn("_top", top)
    winner = F.filter("_scored", lambda x: x["score"] == F.col("_top"))[0]["lang"]
    mass = F.aggregate("_scored", F.lit(0.0), lambda s, x: s + F.exp(x["score"] - F.col("_top")))
    fused = fused.withColumns({"lang": winner, "probability": F.lit(1.0) / mass})
    return with_input(fused)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page."""
    langs, model = fit_text_model(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    fused = fuse(pages, langs, model)
    return fused.select(
        "page_id", "lang", F.round("probability", 6).alias("probability"), "vote", "declared", "suffix", "host"
    )

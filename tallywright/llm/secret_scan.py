"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found per document: `assign`, `access` and `hex` by their patterns, and `token`, a bare run
of 20 or more key characters that mixes upper case, lower case and digits. Hashes of the values are then
counted over the whole corpus by distinct repository and owner. A value of one owner looks live; a value
of many owners is a copied example. `assign`, `access` and `hex` spans are always reported; a `token` is
reported only if it belongs to few enough owners and no other span covers it.

Offsets count code points. `split` gives the text between matches, so a match starts where the pieces
and matches before it end: a running sum over the matches of one document and kind.

Nulls and odd rows: a null text is empty and has no span; every row of the input gives one row, also rows
that repeat or have a null doc_id; a null owner or repository counts as one of its own; an empty table
gives an empty result. Other columns of the input are not read.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .tasks import staged, whole_text

# Fixed values of the contract: kinds in their order, patterns, least lengths.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{32,}"  # a run of 32 or more is what [0-9a-f]+ finds and the least length keeps
TOKEN = "[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "token")
BASE = KINDS[:3]

# Owners up to which a value counts as live.
LIVE_OWNERS = 1


def _found(text: Column, pattern: str, group: int) -> Column:
    """Matches as (gap before, length, value); empty where the text has none."""
    pieces = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    gaps = F.transform(pieces, F.char_length)
    lengths = F.transform(matches, F.char_length)
    zipped = F.arrays_zip(gaps.alias("gap"), lengths.alias("length"), values.alias("value"))
    # There is one piece more than there are matches.
    return F.when(text.rlike(pattern), F.slice(zipped, F.lit(1), F.size(matches)))


def candidates(docs: DataFrame, owner: str = "source", repository: list[str] | None = None) -> DataFrame:
    """One row per document, written out: `row, doc_id, owner, repository, found`, without texts.

    `owner` names a column, `repository` the columns that together name a repository.
    """
    names = [owner] if repository is None else repository
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.concat_ws("/", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names)).alias("repository"),
        whole_text().alias("_text"),
    )
    text = F.col("_text")
    patterns = {"assign": (ASSIGN, 1), "access": (ACCESS, 0), "hex": (HEX, 0), "token": (TOKEN, 0)}
    found = {kind: _found(text, *how).alias(kind) for kind, how in patterns.items()}
    return staged(texts.select("row", "doc_id", "owner", "repository", *found.values()), "candidates")


def spans_of(found: DataFrame) -> DataFrame:
    """`row, owner, repository, kind, start, end, value`: candidates of sufficient length and mix."""
    stack = F.explode(
        F.array(*(F.struct(F.lit(n).alias("order"), F.lit(k).alias("kind"), F.col(k).alias("list")) for n, k in enumerate(KINDS)))
    )
    some = found.filter(F.coalesce(*(F.col(k) for k in KINDS)).isNotNull())
    lists = some.repartition("row").select("row", "owner", "repository", stack.alias("k"))
    each = lists.select("row", "owner", "repository", "k.order", "k.kind", F.posexplode("k.list").alias("at", "m"))
    through = Window.partitionBy("row", "kind").orderBy("at")
    end = F.sum(F.col("m.gap") + F.col("m.length")).over(through)
    placed = each.withColumn("end", end).select(
        *("row", "owner", "repository", "order", "kind"),
        (F.col("end") - F.col("m.length")).alias("start"),
        "end",
        F.col("m.value").alias("value"),
    )
    value, kind = F.col("value"), F.col("kind")
    mixed = value.rlike("[A-Z]") & value.rlike("[a-z]") & value.rlike("[0-9]")
    fits = (
        ((kind == "assign") & (F.char_length(value) >= 8))
        | ((kind == "access") & (F.char_length(value) >= 16))
        | (kind == "hex")
        | ((kind == "token") & mixed)
    )
    return placed.filter(fits)


def ownership(spans: DataFrame) -> DataFrame:
    """`value_hash, n_repositories, n_owners` of every candidate value.

    Counted over distinct (value, repository, owner), which is reduced map-side, so a value that a
    third of all documents copy costs each task one row per repository.
    """
    distinct = spans.select("value_hash", "repository", "owner").distinct()
    return distinct.groupBy("value_hash").agg(
        F.countDistinct("repository").alias("n_repositories"), F.countDistinct("owner").alias("n_owners")
    )


def scan(
    docs: DataFrame, owner: str = "source", repository: list[str] | None = None, live_owners: int = LIVE_OWNERS
) -> DataFrame:
    """One row per document: `row, doc_id, found`, the latter an array of (start, order, kind, end,
    value_hash, n_repositories, n_owners, live) in the order of start, then kind, or null."""
    found = candidates(docs, owner, repository)
    spans = spans_of(found).withColumn("value_hash", F.sha2("value", 256)).drop("value")
    spans = staged(spans, "spans")
    counts = staged(ownership(spans), "ownership")
    known = spans.join(counts, "value_hash").withColumn("live", F.col("n_owners") <= live_owners)
    entry = F.struct("start", "order", "kind", "end", "value_hash", "n_repositories", "n_owners", "live")
    lists = known.groupBy("row").agg(F.array_sort(F.collect_list(entry)).alias("all"))
    base = F.filter("all", lambda x: x["kind"] != "token")
    bare = F.filter("all", lambda x: (x["kind"] == "token") & x["live"])
    covered = lambda x: F.exists("base", lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))
    lists = lists.select("row", base.alias("base"), bare.alias("bare"))
    kept = F.array_sort(F.concat("base", F.filter("bare", lambda x: ~covered(x))))
    lists = staged(lists.select("row", kept.alias("found")), "span-lists")
    return found.select("row", "doc_id").join(lists, "row", "left")


def written(spans: Column) -> Column:
    """`kind:start:end`, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))),
        ",",
    )


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of every document; a repository is a source's part in one language."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = scan(docs, "source", ["source", "lang"])
    count = lambda kind: F.coalesce(F.size(F.filter("found", lambda x: x["kind"] == kind)), F.lit(0)).cast("long")
    base = F.filter("found", lambda x: x["kind"] != "token")
    live = F.size(F.filter("found", lambda x: x["live"]))
    return rows.withColumn("found", F.coalesce("found", F.array().cast(rows.schema["found"].dataType))).select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("found")).alias("spans"),
        live.cast("long").alias("n_live"),
        (F.size("found") - live).cast("long").alias("n_copied"),
    )

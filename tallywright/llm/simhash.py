"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are compared in tiles with numpy exclusive-or and bit counts. Within `radius`
differing bits two fingerprints agree on at least one of `radius + 1` equal stretches of their bits, so
tiles hold fingerprints with one prefix of one stretch, and no link is lost. The prefix gets longer with
the number of fingerprints, so a tile keeps its size while the data grow.

What is more than one tile under one key is dealt to tiles by the number of its bits, those of one number
by a hash as well. Two tiles whose bit counts differ by more than the radius hold no link and never meet:
such pairs are skipped before anything is sent. Each other pair is compared in a task of its own, where
blocks are skipped by bit count in the same way. A pair returns the links of a spanning forest, not all
pairs.

Nulls and odd rows: a null text is empty, texts without words share the fingerprint zero; rows with null
doc_id are linked like others and have no say in the component's id unless the whole component is null;
repeated rows are linked to each other; an empty table gives an empty result. Columns other than
`doc_id, text` are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .components import components
from .tasks import drop_rows, named, names_of, row_number, ship, staged, whole_text

SEED = 42
WORDS = 3
RADIUS = 3
WORD_BITS = 64
# Fingerprints in one tile.
TILE = 2048


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of each word shingle, in order; a text of fewer words is one shingle."""
    from xxhash import xxh64_intdigest

    found = text.encode().lower().split()  # bytes lower A-Z and split at ASCII white space only
    if not found:
        return np.zeros(0, "<u8")
    data = b" ".join(found)
    if len(found) <= words:
        digests = [xxh64_intdigest(data, SEED)]
    else:
        ends = np.cumsum([len(word) + 1 for word in found]) - 1
        starts = np.concatenate([[0], ends[:-words] + 1]).tolist()
        digests = [xxh64_intdigest(data[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist())]
    return np.array(digests, "<u8")


def fingerprint(text: str, words: int = WORDS) -> int:
    """A bit is set if it is set in over half of the hashes; repeated shingles count each time."""
    hashes = shingle_hashes(text, words)
    if not len(hashes):
        return 0
    by_byte = hashes.view(np.uint8).reshape(-1, 8)
    ones = [np.bincount(by_byte[:, place], minlength=256) @ _BYTE_BITS for place in range(8)]
    return int(np.packbits(np.concatenate(ones) * 2 > len(hashes), bitorder="little").view("<u8")[0])


_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """`row, doc_id, fp` and the rows' names, if any, written out; `fp` is a signed 64-bit integer."""
    ship(docs.sparkSession)
    names = names_of(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(text.as_py(), words) for text in batch["text"]], np.uint64)
            columns = [batch["row"], batch["doc_id"], pa.array(found.view(np.int64)), *(batch[c] for c in names)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "fp", *names])

    rows = docs.select(
        row_number(),
        F.col("doc_id").cast("long").alias("doc_id"),
        whole_text().alias("text"),
        *names,
    )
    schema = "row long, doc_id long, fp long" + "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in names)
    return staged(rows.mapInArrow(run, schema), "fingerprints")


def stretches(radius: int) -> list[tuple[int, int]]:
    """First bit and width of `radius + 1` stretches that cover 64 bits."""
    cuts = [round(WORD_BITS * i / (radius + 1)) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def compare_tiles(fps: np.ndarray, side: np.ndarray | None, radius: int, block: int = 64) -> list[tuple[int, int]]:
    """Links, as places, of a spanning forest over fingerprints within `radius` bits.

    With `side` only pairs of different sides are compared.
    """
    fps = fps.view(np.uint64)
    counts = np.bitwise_count(fps).astype(np.int64)
    order = np.lexsort((fps, counts))
    fps, counts = fps[order], counts[order]
    side = None if side is None else side[order]
    tops = np.searchsorted(counts, counts + radius, side="right")
    label, links = np.arange(len(fps)), []
    for low in range(0, len(fps), block):
        high = min(low + block, len(fps))
        top = int(tops[high - 1])
        near = np.bitwise_count(fps[low:high, None] ^ fps[None, low:top]) <= radius
        for at in np.flatnonzero(near.any(1)).tolist():
            i = low + at
            found = i + 1 + np.flatnonzero(near[at, at + 1 :])
            if side is not None:
                found = found[side[found] != side[i]]
            labels = label[found]
            for other in np.unique(labels[labels != label[i]]).tolist():
                links.append((int(order[i]), int(order[found[np.argmax(labels == other)]])))
                label[label == other] = label[i]
    return links


def _by_prefix(distinct: DataFrame, n: int, radius: int, tile: int) -> DataFrame:
    """`id, fp, key` for each fingerprint and each of its stretches."""
    cuts = stretches(radius)
    # Prefix bits for about half a tile under each prefix.
    bits = max(0, min(*(width for _, width in cuts), int(np.ceil(np.log2(max(1, 2 * n / tile))))))
    prefixes = [
        F.shiftrightunsigned("fp", start).bitwiseAND((1 << bits) - 1) * len(cuts) + number
        for number, (start, _) in enumerate(cuts)
    ]
    return distinct.select("id", "fp", F.explode(F.array(*prefixes)).alias("key"))


def _tile(ones: Column, part: Column) -> Column:
    """The name of a tile: number of bits, then part."""
    return F.shiftleft((ones + 1).cast("long"), 32) + part


def dealt(entries: DataFrame, radius: int, tile: int) -> DataFrame:
    """`key, low, high, own, id, fp`: each fingerprint in every pair of tiles that it takes part in.

    Keys of at most one tile are one pair, of that tile with itself. For others a tile meets only those
    whose bit counts are within `radius` of its own.
    """
    entries = entries.withColumn("ones", F.bit_count("fp").cast("int"))
    counts = entries.groupBy("key", "ones").agg(F.count("*").alias("n"))
    parts = F.struct("ones", F.ceil(F.col("n") / tile).cast("int").alias("parts"))
    # At most 65 bit counts for each large key.
    large = counts.groupBy("key").agg(
        F.sum("n").alias("members"), F.map_from_entries(F.collect_list(parts)).alias("parts")
    )
    large = staged(large.filter(F.col("members") > tile).select("key", "parts"), "large-keys")
    known = entries.join(large, "key", "left")

    def tiles_of(ones: Column) -> Column:
        n = F.coalesce(F.try_element_at("parts", ones), F.lit(0))
        numbers = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(numbers, lambda part: _tile(ones, part))

    part = F.pmod(F.xxhash64("id"), F.try_element_at("parts", F.col("ones"))).cast("int")
    own = F.when(F.col("parts").isNull(), F.lit(0).cast("long")).otherwise(_tile(F.col("ones"), part))
    near = F.sequence(F.col("ones") - radius, F.col("ones") + radius)
    others = F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        F.flatten(F.transform(near, tiles_of))
    )
    met = known.withColumn("own", own).withColumn("other", F.explode(others))
    low, high = F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    return met.select("key", low, high, "own", "id", "fp")


def links_within(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """`a, b`: links between ids that connect all of `distinct` (id, fp) within `radius` bits."""
    ship(distinct.sparkSession)
    entries = dealt(_by_prefix(distinct, distinct.count(), radius, tile), radius, tile)

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids, own = table["id"].to_numpy(), table["own"].to_numpy()
        # Pairs inside one tile are the business of that tile with itself.
        side = None if key[1].as_py() == key[2].as_py() else own
        found = compare_tiles(table["fp"].to_numpy(), side, radius)
        a, b = ([ids[link[end]] for link in found] for end in (0, 1))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return entries.groupBy("key", "low", "high").applyInArrow(run, "a long, b long").distinct()


def near_groups(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """`row, doc_id, fp, component_id, stays`: one row of each component stays, the one with its id."""
    rows = fingerprints(docs, words)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    distinct = rows.groupBy("fp").agg(first, F.count("*").alias("n_rows"))
    distinct = staged(distinct.withColumn("id", F.col("first.row")), "distinct")
    links = links_within(distinct.select("id", "fp"), radius, tile)
    roots = staged(components(links, "a", "b"), "roots")
    # Only fingerprints with a partner, or with several rows, need a lookup.
    heads = roots.select(F.col("root").alias("node"), "root").distinct()
    joined = distinct.join(roots.unionByName(heads), distinct["id"] == F.col("node"), "left")
    shared = joined.filter("node IS NOT NULL OR n_rows > 1").select(
        "fp", "first", F.coalesce("root", "id").alias("root")
    )
    shared = staged(shared, "shared")
    firsts = staged(shared.groupBy("root").agg(F.min("first").alias("head")), "firsts")
    members = staged(shared.join(firsts, "root").select("fp", "head"), "members")
    return rows.join(members, "fp", "left").select(
        "row",
        "doc_id",
        "fp",
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        F.coalesce(F.col("head.row") == F.col("row"), F.lit(True)).alias("stays"),
        *names_of(rows),
    )


def without_near_copies(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """`docs`, all columns, with one row of each component of fingerprints within `radius` bits."""
    docs = named(docs)
    return drop_rows(docs, near_groups(docs, words, radius).filter("NOT stays"))


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    groups = near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return groups.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")

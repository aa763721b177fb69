"""Removal of repeated byte strings, by suffix arrays over the places where repeats can be.

A byte goes if a string of `length` bytes that covers it also starts in a document with a smaller
doc_id. Strings are judged on the input and never cross documents.

1. Documents are put together in batches of a few MB, one row each.
2. Every string of `length` bytes has an anchor: its inner k-gram with the smallest hash. Neighbouring
   strings mostly share theirs, so about one place in ten is an anchor. Equal strings have equal
   anchors; a string whose anchor no other document has is not repeated. Each batch sends its distinct
   anchors, four bytes each, and learns which of them another document has. Nothing is decided by a hash
   here: what has an anchor in common is only looked at further.
3. The text around each shared anchor, as far as the strings reach that it serves, is a record. Records
   are dealt by anchor, so equal strings meet whatever documents they come from; a batch sends each
   record once.
4. Each task sorts its records in shards of bounded size by a suffix array: by the first eight bytes, then
   Larsson-Sadakane refinement, which sorts only what is still unsorted by the ranks half a prefix on.
   Neighbours whose common prefix reaches `length` hold the same string. Prefixes are compared directly:
   Kasai's bound, one less than at the place before, needs suffixes sorted to their ends, and these are
   sorted only as far as strings reach. The strings of a shard are merged with those of the others by
   binary search, which gives every string its smallest doc_id.
5. The strings found go back to their batches, named by the place of their record, and the bytes that
   they cover are taken out wherever the record occurs. Anchors are found anew each time a batch is read:
   that is cheaper than keeping them.

A passage that a third of all documents share is one record per batch in step 3, so no task sees all its
copies. Its edges stand beside something else in every document, though, and all these records would have
one anchor. Batches count their different records of an anchor that stands often in them; one with more
than `HOT_RECORDS` beyond the first of each batch does not deal records: its strings of `length` bytes are
dealt one by one, by their own content. Batches and shards are bounded in bytes, and what one anchor brings
to a bucket is bounded by `HOT_RECORDS` and `COUNTED` records per batch; the numbers of batches and buckets
grow with the data.

Nulls and odd rows: a null text is empty, a null doc_id is smaller than any other; rows with one doc_id
do not remove anything from each other; texts shorter than `length` keep all bytes; an empty table gives
an empty result. Columns other than `doc_id, text` are not read. A text may have up to 1 GB.
"""

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from xxhash import xxh64_intdigest

from .tasks import ship, staged, whole_text
from .words import _computed, _position_powers, mixed

LENGTH = 50
GRAM = 32
BATCH_BYTES = 4 << 20
# Input bytes for each bucket of anchors and records, and bytes of records sorted at once.
BUCKET_BYTES = 6 << 20
SHARD_BYTES = 4 << 20
# Records of one anchor, beside the first of each batch, before its strings are dealt one by one: this
# makes up to 19 strings of each record, so it is left to anchors that would fill a task.
HOT_RECORDS = 100_000
# A batch counts the records of an anchor that stands more often in it than this.
COUNTED = 15

_PLACE_BITS = np.uint64(30)
_NONE = np.iinfo(np.int64).min

BATCHES = "batch long, n_bytes long, doc_ids binary, lengths binary, payload binary"
ANCHORS = "bucket int, batch long, n int, codes binary, several binary, extra binary"
SHARED = "bucket int, batch long, n int, codes binary, hot binary"
RECORDS = "bucket int, batch long, ints binary, longs binary, payload binary"
RUNS = "batch long, ints binary, longs binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"


def _batch(fields: str, *columns: list) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    names, types = zip(*(field.split() for field in fields.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], names=list(names))


def _longs(values) -> bytes:
    return np.asarray(values, "<i8").tobytes()


def _read(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(data, kind)


def batches_of(docs: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Documents of a few MB together in one row, written out, texts compressed."""
    ship(docs.sparkSession)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        keys, texts, held = [], [], 0

        def closed() -> pa.RecordBatch:
            lengths = [len(text) for text in texts]
            payload = zstandard.compress(b"".join(texts), 3)
            return _batch(BATCHES, [number], [held], [_longs(keys)], [_longs(lengths)], [payload])

        for frame in frames:
            for key, text in zip(frame["doc_id"], frame["text"]):
                data = text.as_py().encode()
                if texts and held + len(data) > batch_bytes:
                    yield closed()
                    number, keys, texts, held = number + 1, [], [], 0
                keys.append(_NONE if key.as_py() is None else key.as_py())
                texts.append(data)
                held += len(data)
        if texts:
            yield closed()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return staged(texts.mapInArrow(run, BATCHES), "text-batches")


class _Text:
    """The documents of one batch: bytes, first byte, length and doc_id of each."""

    def __init__(self, row: dict):
        self.doc_ids, self.lengths = _read(row["doc_ids"], "<i8"), _read(row["lengths"], "<i8")
        self.data = zstandard.decompress(row["payload"])
        self.starts = np.cumsum(self.lengths) - self.lengths

    def anchors(self, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each anchor: hash, document, first and last start of the strings it serves."""
        data = np.frombuffer(self.data, np.uint8)
        none = np.zeros(0, np.int64)
        if len(data) < length:
            return none.astype(np.uint64), none, none, none
        up, down = _position_powers(len(data)) if len(data) <= BATCH_BYTES else _computed(len(data))
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
        n = len(data) - gram + 1
        hashes = mixed((total[gram:] - total[:n]) * down[:n])
        # Hash above, place below: the smallest is the leftmost of the smallest hashes.
        best = (hashes >> _PLACE_BITS << _PLACE_BITS) | np.arange(n, dtype=np.uint64)
        span, wide = 1, length - gram + 1
        while span < wide:
            step = min(span, wide - span)
            best = np.minimum(best[:-step], best[step:])
            span += step
        best &= (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
        holding = np.flatnonzero(self.lengths >= length)
        if not len(holding):
            return none.astype(np.uint64), none, none, none
        starts = self.starts[holding]
        ends = starts + self.lengths[holding] - length  # where the last string of a document starts
        # Inside a document an anchor begins where another place is the smallest.
        inside = np.zeros(len(best) + 1, np.int8)
        inside[starts] = 1
        inside[ends + 1] -= 1
        inside = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
        inside[1:] &= best[1:] != best[:-1]
        inside[starts] = True
        first = np.flatnonzero(inside)
        document = np.searchsorted(starts, first, side="right") - 1
        last = np.minimum(np.append(first[1:], len(best)) - 1, ends[document])
        return hashes[best[first].astype(np.int64)], holding[document], first, last


def _sorted_in(values: np.ndarray, within: np.ndarray) -> np.ndarray:
    """Which of `values` are in the sorted `within`."""
    if not len(within):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(within, values), len(within) - 1)
    return within[at] == values


def eight_bytes(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number that sorts like them."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(len(text), np.uint64)
    for place in range(8):
        key = (key << np.uint64(8)) | padded[place : place + len(text)]
    return key


def suffix_array(text: np.ndarray, depth: int, key: np.ndarray) -> np.ndarray:
    """Suffixes of `text` (bytes) sorted by their first `depth` bytes at least."""
    n = len(text)
    order = np.argsort(key)
    new = np.append(True, key[order[1:]] != key[order[:-1]])
    heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # a group's rank is its first place
    rank = np.empty(n, np.int64)
    rank[order] = heads
    h = 8
    while h < depth:
        # Places in groups of more than one.
        open_ = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(open_):
            break
        suffixes, group = order[open_], heads[open_]
        ahead = suffixes + h
        by = group * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        resort = np.argsort(by)
        suffixes, by = suffixes[resort], by[resort]
        order[open_] = suffixes
        new[open_] = np.append(True, by[1:] != by[:-1])
        heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[suffixes] = heads[open_]
        h *= 2
    return order


def common_prefixes(key: np.ndarray, suffixes: np.ndarray, most: int) -> np.ndarray:
    """Length, up to `most`, of the common prefix of each of `suffixes` with the one before it.

    `key` has the eight bytes from each place on; every suffix has `most` bytes. The first gets 0.
    All neighbours are compared at once, eight bytes a step, those that still agree a step further.
    """
    lcp = np.zeros(len(suffixes), np.int64)
    going = np.arange(1, len(suffixes))
    for at in range(0, most, 8):
        differ = key[suffixes[going] + at] ^ key[suffixes[going - 1] + at]
        same = sum(((differ >> np.uint64(64 - 8 * n)) == 0).astype(np.int64) for n in range(1, 8))
        lcp[going] = np.minimum(at + same + (differ == 0), most)
        going = going[differ == 0]
    return lcp


class _Shard:
    """Records sorted together: each string of `length` bytes, and the smallest doc_id that holds it."""

    def __init__(self, records: list[bytes], docs: np.ndarray, length: int):
        text = np.frombuffer(b"\xff".join(records) + b"\xff", np.uint8)  # no text holds this byte
        sizes = np.array([len(x) for x in records])
        starts = np.cumsum(sizes + 1) - sizes - 1
        key = eight_bytes(text)
        order = suffix_array(text, length, key)
        record = np.repeat(np.arange(len(records)), sizes + 1)
        offset = np.arange(len(text)) - starts[record]
        # Only whole strings count. Those of one content are neighbours.
        self.suffix = order[(offset + length <= sizes[record])[order]]
        new = common_prefixes(key, self.suffix, length) < length
        self.run = np.cumsum(new) - 1
        self.record, self.offset = record[self.suffix], offset[self.suffix]
        heads = self.suffix[np.flatnonzero(new)]
        self.least = np.minimum.reduceat(docs[self.record], np.flatnonzero(new)) if len(heads) else np.zeros(0, np.int64)
        view = np.lib.stride_tricks.sliding_window_view(text, length)[heads] if len(heads) else np.zeros((0, length), np.uint8)
        self.heads = np.ascontiguousarray(view).view(f"S{length}").ravel()


def merge_shards(shards: list[_Shard]) -> tuple[np.ndarray, np.ndarray]:
    """All strings of all shards, sorted, and the smallest doc_id of each."""
    strings, least = shards[0].heads, shards[0].least.copy()
    for shard in shards[1:]:
        at = np.searchsorted(strings, shard.heads)
        known = np.zeros(len(at), bool)
        inside = at < len(strings)
        known[inside] = strings[at[inside]] == shard.heads[inside]
        least[at[known]] = np.minimum(least[at[known]], shard.least[known])
        strings = np.insert(strings, at[~known], shard.heads[~known])
        least = np.insert(least, at[~known], shard.least[~known])
    return strings, least


def repeated_strings(
    records: list[bytes], docs: np.ndarray, length: int, shard_bytes: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(record, first offset, last offset, smallest doc_id) of runs of strings, for each shard."""
    cuts, held = [0], 0
    for at, record in enumerate(records):
        if held and held + len(record) > shard_bytes:
            cuts.append(at)
            held = 0
        held += len(record)
    cuts.append(len(records))
    shards = [_Shard(records[a:b], docs[a:b], length) for a, b in zip(cuts, cuts[1:]) if b > a]
    if not shards:
        return
    strings, least = merge_shards(shards) if len(shards) > 1 else (shards[0].heads, shards[0].least)
    for low, shard in zip(cuts, shards):
        found = least[np.searchsorted(strings, shard.heads)] if len(shards) > 1 else least
        smallest = found[shard.run]
        order = np.lexsort((shard.offset, shard.record))
        record, offset, smallest = shard.record[order], shard.offset[order], smallest[order]
        new = np.append(True, (record[1:] != record[:-1]) | (smallest[1:] != smallest[:-1]) | (offset[1:] != offset[:-1] + 1))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(record)) - 1
        yield record[first] + low, offset[first], offset[last], smallest[first]


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    batch_bytes: int = BATCH_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    shard_bytes: int = SHARD_BYTES,
    hot_records: int = HOT_RECORDS,
    counted: int = COUNTED,
) -> DataFrame:
    """One row per document: `doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`."""
    batches = batches_of(docs, batch_bytes)
    size = batches.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(12, -(-size // bucket_bytes))

    def codes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of an anchor, and 32 more bits of its hash; a bucket holds about a million anchors
        at any size of the input, so few of them agree by chance."""
        bucket = hashes % np.uint64(buckets)
        return bucket.astype(np.int32), (hashes // np.uint64(buckets)).astype(np.uint32)

    def anchors(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for row in frame.to_pylist():
                text = _Text(row)
                hashes, owner, begin, end = text.anchors(length, gram)
                bucket, code = codes(hashes)
                order = np.lexsort((owner, code, bucket))
                bucket, code, owner = bucket[order], code[order], owner[order]
                new = np.append(True, (code[1:] != code[:-1]) | (bucket[1:] != bucket[:-1]))[: len(code)]
                heads = np.flatnonzero(new)
                tails = np.append(heads[1:], len(code)) - 1 if len(heads) else heads
                # Different records of each anchor but one, where it stands often.
                extra = np.zeros(len(heads), np.uint16)
                begin, end = begin[order], end[order] + length
                for at in np.flatnonzero(tails - heads >= counted).tolist():
                    a, b = heads[at], tails[at] + 1
                    found = {text.data[x:y] for x, y in zip(begin[a:b].tolist(), end[a:b].tolist())}
                    extra[at] = min(len(found) - 1, 65535)
                bucket, code, several = bucket[heads], code[heads], owner[heads] != owner[tails]
                keys, firsts = np.unique(bucket, return_index=True)
                parts = list(zip(firsts, np.append(firsts[1:], len(bucket))))
                yield _batch(
                    ANCHORS,
                    keys.tolist(),
                    [row["batch"]] * len(keys),
                    [int(b - a) for a, b in parts],
                    [code[a:b].astype("<u4").tobytes() for a, b in parts],
                    [np.packbits(several[a:b]).tobytes() for a, b in parts],
                    [extra[a:b].astype("<u2").tobytes() if extra[a:b].any() else b"" for a, b in parts],
                )

    def shared(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        code = np.concatenate([_read(row["codes"], "<u4") for row in rows])
        several = np.concatenate([np.unpackbits(_read(row["several"], np.uint8))[: row["n"]] for row in rows])
        extra = np.concatenate(
            [_read(row["extra"], "<u2") if row["extra"] else np.zeros(row["n"], "<u2") for row in rows]
        )
        batch = np.repeat(np.arange(len(rows)), [row["n"] for row in rows])
        order = np.argsort(code, kind="stable")
        code, kept, batch = code[order], several[order].astype(bool), batch[order]
        same = code[1:] == code[:-1]
        kept[1:] |= same
        kept[:-1] |= same
        first = np.flatnonzero(np.append(True, ~same))
        more = np.add.reduceat(extra[order].astype(np.int64), first)
        hot = np.repeat(more > hot_records, np.diff(np.append(first, len(code))))[kept]
        code, batch = code[kept], batch[kept]
        order = np.argsort(batch, kind="stable")
        cuts = np.searchsorted(batch[order], np.arange(len(rows) + 1))
        some = [n for n in range(len(rows)) if cuts[n] < cuts[n + 1]]
        mine = [order[cuts[n] : cuts[n + 1]] for n in some]
        keys = [rows[n]["bucket"] for n in some], [rows[n]["batch"] for n in some], [len(x) for x in mine]
        parts = [code[x].tobytes() for x in mine], [np.packbits(hot[x]).tobytes() for x in mine]
        return pa.Table.from_batches([_batch(SHARED, *keys, *parts)])

    def whole(bucket: np.ndarray | int, code: np.ndarray) -> np.ndarray:
        return code.astype(np.int64) * buckets + bucket

    def one_by_one(contents, places, least, most, dealt, alone):
        """Records of hot anchors as strings of `length` bytes, each dealt by its content.

        Their places are told apart by being negative.
        """
        single: dict[bytes, list[int]] = {}
        for at in np.flatnonzero(alone).tolist():
            record, place = contents[at], int(places[at])
            for offset in range(len(record) - length + 1):
                seen = single.setdefault(record[offset : offset + length], [-1 - place - offset, least[at], most[at]])
                seen[1], seen[2] = min(seen[1], least[at]), max(seen[2], most[at])
        kept = np.flatnonzero(~alone)
        more = np.array(list(single.values()), np.int64).reshape(-1, 3).T
        own = np.array([xxh64_intdigest(x) % buckets for x in single], np.int32)
        return (
            [contents[i] for i in kept] + list(single),
            np.concatenate([places[kept], more[0]]),
            np.concatenate([least[kept], more[1]]),
            np.concatenate([most[kept], more[2]]),
            np.concatenate([dealt[kept], own]),
        )

    def records(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        rows = right.to_pylist()
        known = [whole(x["bucket"], _read(x["codes"], "<u4")) for x in rows]
        common = np.concatenate(known) if known else np.zeros(0, np.int64)
        flags = [np.unpackbits(_read(x["hot"], np.uint8))[: x["n"]] > 0 for x in rows]
        hot = np.sort(common[np.concatenate(flags)]) if known else common
        common = np.sort(common)
        for row in left.to_pylist() if len(common) else ():
            text = _Text(row)
            hashes, owner, first, last = text.anchors(length, gram)
            bucket, code = codes(hashes)
            named = whole(bucket, code)
            found = np.flatnonzero(_sorted_in(named, common))
            number: dict[bytes, int] = {}
            of, places = np.empty(len(found), np.int64), []
            for at, (a, b) in enumerate(zip(first[found].tolist(), last[found].tolist())):
                record = text.data[a : b + length]
                of[at] = number.setdefault(record, len(number))
                if len(places) < len(number):
                    places.append(a)
            keys = text.doc_ids[owner[found]]
            least, most = np.full(len(number), np.iinfo(np.int64).max), np.full(len(number), _NONE)
            np.minimum.at(least, of, keys)
            np.maximum.at(most, of, keys)
            dealt, alone = np.empty(len(number), np.int32), np.zeros(len(number), bool)
            dealt[of], alone[of] = bucket[found], _sorted_in(named[found], hot)
            contents, places = list(number), np.array(places, np.int64)
            if alone.any():
                contents, places, least, most, dealt = one_by_one(contents, places, least, most, dealt, alone)
            order = np.argsort(dealt, kind="stable")
            cuts = np.flatnonzero(np.append(True, np.diff(dealt[order]) != 0)) if len(order) else order
            for a, b in zip(cuts, np.append(cuts[1:], len(order))):
                mine = order[a:b]
                ints = np.stack([places[mine], [len(contents[i]) for i in mine]]).astype("<i4").tobytes()
                longs = np.stack([least[mine], most[mine]]).astype("<i8").tobytes()
                payload = zstandard.compress(b"".join(contents[i] for i in mine), 1)
                out.append((int(dealt[mine[0]]), row["batch"], ints, zstandard.compress(longs, 1), payload))
        return pa.Table.from_batches([_batch(RECORDS, *(zip(*out) if out else [[]] * 5))])

    def strings(table: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        sent = []
        for row in table.to_pylist():
            place, sizes = _read(row["ints"], "<i4").reshape(2, -1)
            least, most = _read(zstandard.decompress(row["longs"]), "<i8").reshape(2, -1)
            data, ends = zstandard.decompress(row["payload"]), np.cumsum(sizes)
            of = [number.setdefault(data[b - s : b], len(number)) for b, s in zip(ends.tolist(), sizes.tolist())]
            sent.append((row["batch"], place, np.array(of, np.int64), least, most))
        smallest = np.full(len(number), np.iinfo(np.int64).max)
        for _, _, of, least, _ in sent:
            np.minimum.at(smallest, of, least)
        found = list(repeated_strings(list(number), smallest, length, shard_bytes))
        out: list[tuple] = []
        if found:
            record, first, last, doc = (np.concatenate(x) for x in zip(*found))
            cuts = np.searchsorted(record, np.arange(len(number) + 1))
            for batch, place, of, _, most in sent:
                times = cuts[of + 1] - cuts[of]
                at = np.repeat(cuts[of] - np.cumsum(times) + times, times) + np.arange(times.sum())
                useful = doc[at] < np.repeat(most, times)
                at, place = at[useful], np.repeat(place, times)[useful]
                if len(at):
                    ints = np.stack([place, first[at], last[at]]).astype("<i4").tobytes()
                    out.append((batch, zstandard.compress(ints, 1), zstandard.compress(_longs(doc[at]), 1)))
        return pa.Table.from_batches([_batch(RUNS, *(zip(*out) if out else [[]] * 3))])

    def strings_of(text, places, docs, hashes, owner, first, last):
        """Every start of the strings at `places` in the batch, and whether an earlier document has it."""
        data = text.data
        known = {data[p : p + length]: doc for p, doc in zip(places.tolist(), docs.tolist())}
        named = np.sort(hashes[np.searchsorted(first, places, side="right") - 1])
        found = np.flatnonzero(_sorted_in(hashes, named))
        hits: dict[bytes, list[tuple[int, int]]] = {}
        starts, goes = [], []
        for x, y, document in zip(first[found].tolist(), last[found].tolist(), owner[found].tolist()):
            record = data[x : y + length]
            if record not in hits:
                strings = (record[k : k + length] for k in range(y - x + 1))
                hits[record] = [(k, known[s]) for k, s in enumerate(strings) if s in known]
            key = text.doc_ids[document]
            for offset, doc in hits[record]:
                starts.append(x + offset)
                goes.append(doc < key)
        return np.array(starts, np.int64), np.array(goes, bool)

    def cleaned(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[dict] = []
        runs = [
            (_read(zstandard.decompress(x["ints"]), "<i4").reshape(3, -1), _read(zstandard.decompress(x["longs"]), "<i8"))
            for x in right.to_pylist()
        ]
        for row in left.to_pylist():
            text = _Text(row)
            edge = np.zeros(len(text.data) + 1, np.int32)
            if runs:
                record, a, b = np.concatenate([x for x, _ in runs], axis=1).astype(np.int64)
                doc = np.concatenate([x for _, x in runs])
                hashes, owner, first, last = text.anchors(length, gram)
                single = record < 0
                if single.any():
                    start, goes = strings_of(text, -1 - record[single], doc[single], hashes, owner, first, last)
                    np.add.at(edge, start[goes], 1)
                    np.add.at(edge, start[goes] + length, -1)
                    record, a, b, doc = record[~single], a[~single], b[~single], doc[~single]
                order = np.argsort(record, kind="stable")
                record, a, b, doc = record[order], a[order], b[order], doc[order]
                named = np.unique(record)
                at_named = np.searchsorted(first, named)
                place_of = {
                    text.data[x : y + length]: x for x, y in zip(first[at_named].tolist(), last[at_named].tolist())
                }
                found = np.flatnonzero(_sorted_in(hashes, np.sort(hashes[at_named])))
                of = np.array(
                    [place_of.get(text.data[x : y + length], -1) for x, y in zip(first[found].tolist(), last[found].tolist())],
                    np.int64,
                )
                found, of = found[of >= 0], of[of >= 0]
                low = np.searchsorted(record, of)
                times = np.searchsorted(record, of, side="right") - low
                at = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
                place = np.repeat(first[found], times)
                goes = doc[at] < text.doc_ids[np.repeat(owner[found], times)]
                np.add.at(edge, (place + a[at])[goes], 1)
                np.add.at(edge, (place + b[at])[goes] + length, -1)
            gone = np.cumsum(edge[:-1]) > 0
            for key, start, size in zip(text.doc_ids.tolist(), text.starts.tolist(), text.lengths.tolist()):
                mine = gone[start : start + size]
                data = text.data[start : start + size]
                spans: list[dict] = []
                if mine.any():
                    turns = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0))
                    spans = [{"start": x, "end": y} for x, y in turns.reshape(-1, 2).tolist()]
                    data = np.frombuffer(data, np.uint8)[~mine].tobytes()
                out.append(
                    {
                        "doc_id": None if key == _NONE else key,
                        "n_bytes": size,
                        "n_removed": size - len(data),
                        "n_spans": len(spans),
                        "kept_sha256": sha256(data).hexdigest(),
                        "spans": spans,
                    }
                )
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        kinds = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())]
        return pa.Table.from_pylist(out, pa.schema([*kinds, ("kept_sha256", pa.string()), ("spans", pa.list_(span))]))

    known = batches.mapInArrow(anchors, ANCHORS).groupBy("bucket").applyInArrow(shared, SHARED)
    cut = batches.groupBy("batch").cogroup(known.groupBy("batch")).applyInArrow(records, RECORDS)
    found = cut.groupBy("bucket").applyInArrow(strings, RUNS)
    return batches.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(cleaned, RESULT)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 50 bytes that an earlier document has."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")

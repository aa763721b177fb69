"""Placement of rows in shards by a permutation-filled lookup table, in DataFrame functions only.

Every shard has its own permutation of the slots of a prime-sized table. Shards take turns; at its turn a
shard claims the first slot of its permutation that is still free, until the table is full. So each shard
owns as many slots as any other, give or take one, and when a shard leaves, nearly all slots of the others
stay theirs. A row's key is hashed to a slot, and the table, broadcast, gives the shard in constant time.

The table is a parameter, not data: its size depends on the number of shards alone.

Nulls and odd rows: rows with one key go to one shard; a row with a null key is placed by its text, so
such rows do not meet in one shard, and if the text is null as well by the empty text; an empty table
gives an empty result. Placing drops no row and adds none. Columns `slot, shard` of the input are
replaced.
"""

from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .tasks import private

SHARDS = 32
# Slots for each shard; the table size is the next prime above.
SLOTS_PER_SHARD = 100
# The largest table that is broadcast: 2 ** 22 rows of 12 bytes.
MOST_SLOTS = 1 << 22


def next_prime(n: int) -> int:
    while n < 2 or any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def fill(names: list[str], size: int) -> list[int]:
    """The number of the owner of each slot."""
    if not names:
        raise ValueError("no shard")
    if size != next_prime(size):
        raise ValueError(f"{size} is no prime: a shard's steps would not reach every slot")
    digests = [md5(name.encode()).hexdigest() for name in names]
    offsets = [int(d[:15], 16) % size for d in digests]
    skips = [int(d[15:30], 16) % (size - 1) + 1 for d in digests]
    owner, tried = [-1] * size, [0] * len(names)
    free = size
    while True:
        for shard in range(len(names)):
            while True:
                slot = (offsets[shard] + tried[shard] * skips[shard]) % size
                tried[shard] += 1
                if owner[slot] < 0:
                    break
            owner[slot] = shard
            free -= 1
            if not free:
                return owner


def lookup_table(spark: SparkSession, names: list[str], size: int | None = None) -> DataFrame:
    """`slot, shard` for every slot."""
    size = size or next_prime(SLOTS_PER_SHARD * len(names))
    if size > MOST_SLOTS:
        raise ValueError(f"a table of {size} slots is too large to broadcast")
    owners = ",".join(map(str, fill(names, size)))
    listed = F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "owner")
    return spark.range(1).select(listed).select("slot", F.col("owner").cast("int").alias("shard"))


def slot_of(key: Column, size: int) -> Column:
    """60 bits of the key's MD5 modulo the table size."""
    return (F.conv(F.substring(F.md5(key.cast("string")), 1, 15), 16, 10).cast("long") % size).cast("int")


def place(docs: DataFrame, names: list[str], key: str = "doc_id", text: str = "text", size: int | None = None) -> DataFrame:
    """Every row of `docs` with its `slot` and `shard`."""
    size = size or next_prime(SLOTS_PER_SHARD * len(names))
    table = lookup_table(docs.sparkSession, names, size)
    by = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("text:"), F.col(text)), F.lit("text:"))
    slotted = private(docs, "slot", "shard").withColumn("slot", slot_of(by, size))
    return slotted.join(F.broadcast(table), "slot")


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """One folder per shard of `files_per_shard` files; rows of a shard are dealt to them by content."""
    salt = F.pmod(F.xxhash64(*placed.columns), F.lit(files_per_shard))
    placed.repartition("shard", salt).write.partitionBy("shard").parquet(path)


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i}" for i in range(n)]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return place(docs, shard_names()).select("doc_id", "slot", "shard")

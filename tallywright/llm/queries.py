"""The registered queries of the corpus operators, and SQL where SQL can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontaminate import op10_decontamination
from .exact import op4_exact_dedup
from .language import op6_language_id
from .lexical import TOP, op13_lexical_search
from .packing import op8_packing
from .secret_scan import op7_secret_scan
from .sharding import SHARDS, SLOTS_PER_SHARD, next_prime, op1_sharding
from .simhash import op5_simhash
from .suffixes import op9_suffix_dedup
from .token_counts import op12_token_counts
from .token_files import op3_token_files
from .toxicity import op2_toxicity
from .whitening import op11_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_toxicity,
        op3_token_files,
        op4_exact_dedup,
        op5_simhash,
        op6_language_id,
        op7_secret_scan,
        op8_packing,
        op9_suffix_dedup,
        op10_decontamination,
        op11_whitening,
        op12_token_counts,
        op13_lexical_search,
    )
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed: what terms of the ranked search are made of.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SLOTS = next_prime(SLOTS_PER_SHARD * SHARDS)

ORACLE = {
    # Shards take turns, one claim per step of the recursion; `owner` is the table so far.
    "op1_sharding": f"""
        WITH RECURSIVE shards AS (
            SELECT i, ('0x' || substr(md5('shard-' || i), 1, 15))::BIGINT % {SLOTS} AS first_slot,
                   ('0x' || substr(md5('shard-' || i), 16, 15))::BIGINT % ({SLOTS} - 1) + 1 AS skip
            FROM range({SHARDS}) r(i)
        ), claims(n, owner) AS (
            SELECT 0, list_transform(range({SLOTS}), lambda x: -1)
            UNION ALL
            SELECT n + 1, list_concat(owner[:slot], [n % {SHARDS}], owner[slot + 2:])
            FROM (
                SELECT n, owner, list_filter(
                    list_transform(range({SLOTS}), lambda k: (first_slot + k * skip) % {SLOTS}),
                    lambda s: owner[s + 1] < 0
                )[1] AS slot
                FROM claims JOIN shards ON i = n % {SHARDS}
                WHERE n < {SLOTS}
            )
        ), filled AS (SELECT owner FROM claims WHERE n = {SLOTS}),
        lookup AS (SELECT unnest(range({SLOTS})) AS slot, unnest(owner) AS shard FROM filled),
        slotted AS (
            SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'text:' || text, 'text:')), 1, 15))::BIGINT
                           % {SLOTS} AS slot
            FROM documents
        )
        SELECT doc_id, slot::INTEGER AS slot, shard::INTEGER AS shard FROM slotted JOIN lookup USING (slot)
    """,
    "op4_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
        WINDOW same AS (PARTITION BY t)
    """,
    # `row` and `item` tell repeated ids apart; // divides whole numbers, rounding down.
    "op13_lexical_search": rf"""
        WITH split AS (
            SELECT row_number() OVER () AS row, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS words
            FROM documents
        ), docs AS (SELECT *, len(words) AS n FROM split WHERE len(words) > 0),
        corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM docs),
        items AS (
            SELECT row_number() OVER () AS item, item_id,
                   list_distinct(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) AS words
            FROM (SELECT DISTINCT item_id, text FROM benchmark)
        ), asked AS (SELECT item, item_id, unnest(words) AS term FROM items),
        postings AS (
            SELECT row, doc_id, n, term, count(*) AS tf
            FROM (SELECT row, doc_id, n, unnest(words) AS term FROM docs)
            WHERE term IN (SELECT term FROM asked) GROUP BY ALL
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM postings, corpus GROUP BY term, docs
        ), scored AS (
            SELECT item, item_id, row, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
            FROM postings JOIN weights USING (term) JOIN asked USING (term), corpus GROUP BY ALL
        )
        SELECT item_id, rank, doc_id, score
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank
              FROM scored WHERE score > 0)
        WHERE rank <= {TOP}
    """,
}

"""The same results written independently as plain SQL over the given tables (DuckDB dialect)."""

CLASS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _two(value: str) -> str:
    return f"CAST(CAST(({value}) AS DECIMAL(18,2)) AS VARCHAR)"


def _kept(*texts: str) -> str:
    """List of the texts that are not null."""
    return f"list_filter([{', '.join(texts)}]::VARCHAR[], lambda t: t IS NOT NULL)"


def _joined(column: str) -> str:
    return f"CASE WHEN len({column}) > 0 THEN array_to_string({column}, '; ') END"


SOURCE_FILE = (
    "'inv-' || lpad(CAST(k AS VARCHAR), greatest(9, length(CAST(k AS VARCHAR)))::INTEGER, '0') || CASE WHEN k % 151 = 0 THEN '.txt' ELSE '.pdf' END"
)
NUMBER = "'RE-' || CAST(CASE WHEN k % 97 = 0 AND k > 0 THEN k - 1 ELSE k END AS VARCHAR)"

# One row per item: numbered, then with the values an analysis would report, then judged.
ITEMS = f"""
numbered AS (
  SELECT l_orderkey AS k,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                            l_shipdate, l_extendedprice, l_quantity) AS pos,
         l_partkey, l_suppkey, l_shipdate, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(l_quantity AS DECIMAL(9,2)) AS l_qty
  FROM lineitem),
reported AS (
  SELECT n.*, {SOURCE_FILE} AS source_file,
         CASE WHEN k % 29 = 0 THEN 'Item ' || pos ELSE 'Part ' || l_partkey END AS description,
         CASE WHEN k % 43 = 0 AND pos >= 3 THEN 1
              WHEN k % 139 = 0 AND pos = 1 THEN 0 ELSE l_qty END AS qty,
         CASE WHEN pos = 1 AND (k % 13 = 0 OR k % 139 = 0)
              THEN CAST(p_retailprice AS DECIMAL(9,2)) END AS list_price,
         CASE WHEN NOT (k % 41 = 0 AND pos = 2) THEN price END AS line_total
  FROM numbered n LEFT JOIN part ON p_partkey = l_partkey),
judged AS (
  SELECT r.*, line_total IS NULL AS is_skipped,
         CASE WHEN line_total IS NULL THEN 'Line item ' || pos || ' (''' || description
              || ''') had incomplete pricing - skipped' END AS skip_text,
         CASE WHEN line_total IS NOT NULL AND qty <= 0
              THEN 'Line item ' || pos || ': quantity is not greater than 0' END AS error_text,
         CASE WHEN line_total IS NOT NULL AND qty > 0 AND list_price IS NOT NULL
                   AND abs(round_even(qty * list_price, 2) - line_total) > 0.05
              THEN 'Line item ' || pos || ' (''' || description || '''): quantity x unit_price = '
                   || {_two("round_even(qty * list_price, 2)")}
                   || ', but extracted line_total = ' || {_two("line_total")} END AS math_text,
         CASE WHEN list_price IS NOT NULL THEN CAST(list_price AS DOUBLE)
              WHEN qty <> 0 THEN CAST(line_total AS DOUBLE) / CAST(qty AS DOUBLE) END AS unit_price
  FROM reported r)"""

FACTS = f"""{ITEMS},
facts AS (
  SELECT k, count(*) AS n_lines, CAST(sum(price) AS DECIMAL(18,2)) AS lines_sum,
         min(l_shipdate) AS first_ship, max(CASE WHEN pos = 1 THEN l_suppkey END) AS supplier_1,
         count(*) FILTER (WHERE NOT is_skipped) AS n_items,
         CAST(sum(line_total) AS DECIMAL(18,2)) AS items_sum,
         arg_min(error_text, pos) FILTER (WHERE error_text IS NOT NULL) AS item_error,
         coalesce(list(skip_text ORDER BY pos) FILTER (WHERE skip_text IS NOT NULL), []) AS skips,
         coalesce(list(math_text ORDER BY pos) FILTER (WHERE math_text IS NOT NULL), []) AS maths
  FROM judged GROUP BY k)"""

# One row per document: typed header, then warnings, then reasons and issues.
DOCUMENTS = f"""{FACTS},
header AS (
  SELECT o.k, o.source_file, o.invoice_number, invoice_date,
         CASE WHEN o.k % 7 = 0 THEN NULL
              WHEN o.k % 11 = 0 THEN CAST(first_ship AS DATE) + CAST(shift AS INTEGER)
              ELSE invoice_date + 14 END AS due_date,
         CASE WHEN o.k % 113 = 0 THEN NULL WHEN n_lines IS NULL THEN 'Supplier#none'
              ELSE s_name END AS vendor_name,
         coalesce(n_name, 'none') AS vendor_address,
         'DE' || lpad(CAST(supplier_1 AS VARCHAR), greatest(9, length(CAST(supplier_1 AS VARCHAR)))::INTEGER, '0') AS vendor_tax_id,
         c_name AS customer_name, CASE WHEN o.k % 3 <> 0 THEN customer_nation END AS customer_address,
         lines_sum AS subtotal, vat_amount,
         CASE WHEN vat_amount <> 0
              THEN round(CAST(vat_amount AS DOUBLE) / CAST(lines_sum AS DOUBLE), 12) END AS vat_rate,
         CASE WHEN o.k % 127 = 0 THEN NULL WHEN n_lines IS NULL THEN CAST(o_totalprice AS DECIMAL(18,2))
              ELSE CAST((lines_sum + coalesce(vat_amount, 0)
                    + CASE WHEN o.k % 23 = 0 THEN 1.00 WHEN o.k % 31 = 0 THEN 0.01 ELSE 0.00 END)
                    * CASE WHEN o.k % 101 = 0 THEN -1 ELSE 1 END AS DECIMAL(18,2)) END AS total_amount,
         (CASE WHEN o.k % 19 = 0 THEN 0.0 ELSE 0.9 END::DOUBLE + conf
           + CASE WHEN o.k % 113 = 0 THEN 0.0::DOUBLE ELSE conf END + conf) / 4 AS mean_conf,
         CASE WHEN o.k % 37 = 0 THEN
           'vendor_address has low confidence (0.50) - verify against source PDF' END AS address_text,
         coalesce(n_items, 0) AS n_items, items_sum, item_error,
         coalesce(skips, []::VARCHAR[]) AS skips, coalesce(maths, []::VARCHAR[]) AS maths
  FROM (SELECT o_orderkey AS k, {SOURCE_FILE} AS source_file, {NUMBER} AS invoice_number,
               o_custkey, o_totalprice,
               CASE WHEN o_orderkey % 89 = 0 THEN 0 ELSE 1826 END AS shift,
               CAST(o_orderdate AS DATE) + CAST(shift AS INTEGER) AS invoice_date,
               0.9::DOUBLE + CAST(o_orderkey % 10 AS DOUBLE) / 100.0::DOUBLE AS conf
        FROM orders) o
  LEFT JOIN (SELECT *, CASE WHEN k % 20 = 4 THEN NULL ELSE CAST(round_even(lines_sum *
                    CASE k % 20 WHEN 0 THEN 0.35 WHEN 1 THEN 0.00 WHEN 2 THEN 0.07 WHEN 3 THEN 0.07
                    ELSE 0.19 END, 2) AS DECIMAL(18,2)) END AS vat_amount FROM facts) f ON f.k = o.k
  LEFT JOIN supplier ON s_suppkey = supplier_1
  LEFT JOIN nation ON n_nationkey = s_nationkey
  LEFT JOIN (SELECT c_custkey, c_name, n_name AS customer_nation
             FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey) ON c_custkey = o_custkey),
warned AS (
  SELECT h.*, round_even(mean_conf, 4) AS score,
         CASE WHEN k % 151 = 0 THEN 'preprocessing'
              WHEN vendor_name IS NULL OR total_amount IS NULL THEN 'extraction'
              WHEN item_error IS NOT NULL THEN 'unexpected' END AS stage,
         CASE WHEN k % 151 = 0 THEN 'Preprocessing failed: Expected a .pdf file, got ''.txt'''
              WHEN vendor_name IS NULL OR total_amount IS NULL THEN
                'Extraction failed: Missing required field(s): ' || array_to_string({_kept(
                  "CASE WHEN vendor_name IS NULL THEN 'vendor_name' END",
                  "CASE WHEN total_amount IS NULL THEN 'total_amount' END")}, ', ')
              WHEN item_error IS NOT NULL THEN 'Unexpected error: ' || item_error END AS reason,
         list_concat({_kept("address_text")}, skips, {_kept(
           "CASE WHEN n_items = 0 THEN 'No line items were extracted' END",
           "CASE WHEN mean_conf < 0.8 THEN 'Average confidence ' || "
           "CAST(CAST(round_even(CAST(mean_conf AS DECIMAL(18,12)), 2) AS DECIMAL(4,2)) AS VARCHAR)"
           " || ' is below threshold 0.8 - recommend manual review' END")}) AS mapping_warnings,
         CASE WHEN abs(subtotal + vat_amount - total_amount) > 0.05
              THEN 'subtotal + VAT = ' || {_two("subtotal + vat_amount")}
                   || ', but extracted total_amount = ' || {_two("total_amount")}
                   || ' (difference: ' || {_two("abs(subtotal + vat_amount - total_amount)")}
                   || ')' END AS grand_text,
         CASE WHEN n_items > 0 AND abs(items_sum - subtotal) > 0.05
              THEN 'Sum of line items (' || {_two("items_sum")}
                   || ') does not match extracted subtotal (' || {_two("subtotal")} || ')' END AS sum_text
  FROM header h),
checked AS (
  SELECT *, list_concat(mapping_warnings, maths, {_kept("grand_text", "sum_text")}) AS warnings
  FROM warned),
assessed AS (
  SELECT *, {_kept(
    "CASE WHEN score < 0.8 THEN 'Confidence score ' || regexp_replace(CAST(CAST(score AS DECIMAL(5,4)) "
    "AS VARCHAR), '0+$', '') || ' is below threshold 0.8' END",
    "CASE WHEN len(warnings) > 0 THEN len(warnings) || ' extraction/transformation warning(s) present' END",
    "CASE WHEN year(invoice_date) < 2000 THEN 'invoice_date year ' || year(invoice_date) || ' looks implausible' END",
    "CASE WHEN invoice_date > DATE '2006-01-02' THEN 'invoice_date ' || invoice_date || ' is in the future' END",
    "CASE WHEN due_date < invoice_date THEN 'due_date ' || due_date || ' is before invoice_date ' "
    "|| invoice_date || ' - dates may be swapped' END",
    "CASE WHEN vat_rate > 0.005 AND abs(vat_rate - 0.07) > 0.005 AND abs(vat_rate - 0.19) > 0.005 "
    "THEN 'vat_rate ' || CAST(CAST(round(vat_rate, 3) AS DECIMAL(5,3)) AS VARCHAR) "
    "|| ' does not match a standard German rate (0%, 7%, 19%)' END",
    "CASE WHEN total_amount <= 0 THEN 'total_amount ' || CAST(total_amount AS VARCHAR) "
    "|| ' is not a positive value' END",
    "CASE WHEN n_items = 0 THEN 'Invoice has no line items' END")} AS issues
  FROM checked)"""

DECIDED = f"""{DOCUMENTS},
firsts AS (
  SELECT invoice_number, min(source_file) AS first_file FROM assessed WHERE reason IS NULL GROUP BY 1),
decided AS (
  SELECT a.*, a.source_file = f.first_file AS is_first,
         CASE WHEN len(issues) = 0 THEN 'valid' ELSE 'needs_review' END AS status
  FROM assessed a LEFT JOIN firsts f ON f.invoice_number = a.invoice_number),
stored AS (SELECT * FROM decided WHERE reason IS NULL AND is_first),
outcome AS (
  SELECT source_file,
         CASE WHEN reason IS NOT NULL OR NOT is_first THEN 'failed' ELSE status END AS outcome,
         CASE WHEN stage IS NOT NULL THEN stage WHEN NOT is_first THEN 'unexpected' END AS stage,
         CASE WHEN reason IS NOT NULL THEN reason WHEN NOT is_first THEN
              'Unexpected error: UNIQUE constraint failed: invoices.invoice_number' END AS reason,
         CASE WHEN reason IS NOT NULL OR NOT is_first THEN 0 ELSE len(issues) END AS n_issues
  FROM decided)"""

TAKEN = "Unexpected error: UNIQUE constraint failed: invoices.invoice_number"

# Over `runs`, documents with the run they belong to: the earlier run that has a number keeps it, for
# the first of its files in name order.
WINNERS = """run_outcomes AS (
  SELECT *, reason IS NULL AND 1 = row_number() OVER (
             PARTITION BY invoice_number, reason IS NULL ORDER BY turn, source_file) AS won,
         CASE WHEN len(issues) = 0 THEN 'valid' ELSE 'needs_review' END AS status
  FROM (SELECT *, CASE run_id WHEN 'again' THEN 2 WHEN 'odd' THEN 2 ELSE 1 END AS turn FROM runs))"""

RUNS = f"""{DOCUMENTS},
runs AS (SELECT *, CASE WHEN k % 2 = 0 THEN 'even' ELSE 'odd' END AS run_id FROM assessed), {WINNERS},
all_files AS (SELECT source_file FROM run_outcomes),
kept AS (SELECT * FROM run_outcomes WHERE won)"""

ITEM_COLUMNS = (
    "source_file, CAST(pos AS INTEGER) AS position, description, CAST(qty AS DOUBLE) AS quantity, "
    "round(unit_price, 8) AS unit_price, CAST(line_total AS DOUBLE) AS line_total"
)

TRIAGE = """
ids AS (
  SELECT DISTINCT conv_id AS c FROM conversations
  UNION ALL
  SELECT unnest(range(max(conv_id) + 1, max(conv_id) + 21)) FROM conversations),
counted AS (
  SELECT conv_id AS c, count(*) AS n_pages, bool_or(trim(text) <> '') AS any_text
  FROM conversations GROUP BY 1),
files AS (
  SELECT ids.c, 'conv-' || lpad(CAST(ids.c AS VARCHAR), greatest(9, length(CAST(ids.c AS VARCHAR)))::INTEGER, '0') ||
         CASE WHEN ids.c % 11 = 0 THEN '.TXT' WHEN ids.c % 10 = 0 THEN '.PDF' ELSE '.pdf' END AS source_file,
         n_pages, any_text AND ids.c % 7 <> 0 AS any_text,
         CASE WHEN ids.c % 13 = 0 THEN 'File does not exist on disk'
              WHEN ids.c % 11 = 0 THEN 'Expected a .pdf file, got ''.TXT'''
              WHEN ids.c % 19 = 0 THEN 'Could not open file - it may be corrupted: empty file'
              WHEN n_pages IS NULL THEN 'PDF has no pages'
              WHEN ids.c % 17 = 0 THEN 'PDF is password protected'
              ELSE 'OK' END AS reason
  FROM ids LEFT JOIN counted ON counted.c = ids.c)"""

EURO = "CASE WHEN {0} <> 0 THEN '€ ' || format('{{:,.2f}}', {0}) ELSE '—' END"
GERMAN = "translate(format('{:,.2f}', CAST(o_totalprice AS DECIMAL(18,2))), ',.', '.,') || ' EUR'"


def _q(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


ORACLE: dict[str, str] = {
    "assemble_invoices": """
        WITH t AS (
          SELECT l_orderkey AS k, count(*) AS n_items,
                 sum(CAST(l_quantity AS DECIMAL(9,2)) * CAST(p_retailprice AS DECIMAL(9,2))) AS subtotal
          FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
        v AS (SELECT *, round_even(CAST(subtotal AS DECIMAL(16,2)) * 0.19, 2) AS vat FROM t)
        SELECT o_orderkey AS order_key, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS invoice_date,
               strftime(o_orderdate, '%Y-%m-') ||
                 lpad(CAST(least(day(o_orderdate) + 14, 28) AS VARCHAR), 2, '0') AS due_date,
               coalesce(n_items, 0) AS n_items, CAST(CAST(subtotal AS DECIMAL(18,2)) AS DOUBLE) AS subtotal,
               CAST(vat AS DOUBLE) AS vat_amount,
               CAST(CAST(subtotal + vat AS DECIMAL(18,2)) AS DOUBLE) AS total_amount
        FROM orders LEFT JOIN v ON k = o_orderkey""",
    "line_items_flat": _q(
        DECIDED,
        f"SELECT {ITEM_COLUMNS} FROM judged WHERE NOT is_skipped AND k IN (SELECT k FROM stored)",
    ),
    "price_backfill": _q(
        ITEMS, f"SELECT {ITEM_COLUMNS} FROM judged WHERE NOT is_skipped AND error_text IS NULL"
    ),
    "map_fields": _q(
        DOCUMENTS,
        """SELECT source_file, invoice_number, CAST(invoice_date AS VARCHAR) AS invoice_date,
             CAST(due_date AS VARCHAR) AS due_date, vendor_name, vendor_address, vendor_tax_id,
             CAST(NULL AS VARCHAR) AS vendor_iban, customer_name, customer_address,
             CAST(subtotal AS DOUBLE) AS subtotal, CAST(vat_amount AS DOUBLE) AS vat_amount,
             CAST(total_amount AS DOUBLE) AS total_amount FROM header""",
    ),
    "required_fields": f"""
        SELECT source_file, 'Missing required field(s): ' || CASE
                 WHEN k % 113 = 0 AND k % 127 = 0 THEN 'vendor_name, total_amount'
                 WHEN k % 113 = 0 THEN 'vendor_name' ELSE 'total_amount' END AS reason
        FROM (SELECT k, {SOURCE_FILE} AS source_file FROM (SELECT o_orderkey AS k FROM orders))
        WHERE k % 113 = 0 OR k % 127 = 0""",
    "confidence": _q(
        DOCUMENTS,
        """SELECT source_file, score AS confidence_score, mean_conf < 0.8 AS is_low,
             coalesce(address_text, '') AS address_warning FROM warned""",
    ),
    "vat_rate": _q(DOCUMENTS, "SELECT source_file, round(vat_rate, 6) AS vat_rate FROM header"),
    "skip_items": _q(
        DOCUMENTS,
        f"""SELECT source_file, n_items, array_to_string(found, '; ') AS warnings
            FROM (SELECT source_file, n_items, list_concat(skips, {_kept(
                "CASE WHEN n_items = 0 THEN 'No line items were extracted' END")}) AS found FROM header)
            WHERE len(found) > 0""",
    ),
    "model_rejects": _q(
        DOCUMENTS, "SELECT source_file, reason FROM warned WHERE stage = 'unexpected'"
    ),
    "json_fields": """
        SELECT event_id,
               CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0
                    THEN CAST(json_extract(props, '$.k') AS DOUBLE) END AS total_amount,
               CASE WHEN event_id % 7 = 0
                    THEN 'Extraction failed: analysis did not recognize this file as an invoice'
                    WHEN event_id % 11 = 0
                    THEN 'Extraction failed: the recorded analysis response is not readable'
                    WHEN json_extract(props, '$.k') IS NULL
                    THEN 'Extraction failed: analysis did not recognize this file as an invoice'
                    ELSE '' END AS reason
        FROM events""",
    "currency_values": """
        SELECT l_orderkey, l_linenumber, CAST(1 AS INTEGER) AS n_items,
               CASE WHEN l_orderkey % 13 <> 0 THEN CAST(o_totalprice AS DOUBLE) END AS total_amount,
               CAST(l_quantity AS DOUBLE) AS quantity,
               CASE WHEN l_orderkey % 13 <> 0 THEN CAST(l_extendedprice AS DOUBLE) END AS line_total
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "clean_text": f"""
        SELECT doc_id, t AS text, length(t) AS n_chars
        FROM (SELECT doc_id, trim(regexp_replace(text, '{CLASS}', ' ', 'g')) AS t FROM documents)""",
    "line_total_check": _q(
        ITEMS,
        """SELECT source_file, CAST(pos AS INTEGER) AS position, math_text AS warning
           FROM judged WHERE math_text IS NOT NULL""",
    ),
    "grand_total_check": _q(
        DOCUMENTS, "SELECT source_file, grand_text AS warning FROM warned WHERE grand_text IS NOT NULL"
    ),
    "item_sum_check": _q(
        DOCUMENTS,
        """SELECT source_file, n_items, CAST(items_sum AS DOUBLE) AS items_sum, sum_text AS warning
           FROM warned WHERE sum_text IS NOT NULL""",
    ),
    "warnings_ordered": _q(
        DOCUMENTS,
        f"""SELECT source_file, len(warnings) AS n_warnings,
              len(warnings) - len(mapping_warnings) AS n_new_warnings,
              {_joined("warnings")} AS extraction_warnings FROM checked WHERE reason IS NULL""",
    ),
    "plausibility": _q(
        DOCUMENTS,
        f"""SELECT source_file, CASE WHEN len(issues) = 0 THEN 'valid' ELSE 'needs_review' END
              AS validation_status, len(issues) AS n_issues, {_joined("issues")} AS validation_issues
            FROM assessed WHERE reason IS NULL""",
    ),
    "outcomes": _q(DECIDED, "SELECT source_file, outcome, stage, reason, n_issues FROM outcome"),
    "status_counts": _q(
        DECIDED,
        """SELECT count(*) AS total_files, count(*) FILTER (WHERE outcome = 'valid') AS valid,
             count(*) FILTER (WHERE outcome = 'needs_review') AS needs_review,
             count(*) FILTER (WHERE outcome = 'failed') AS failed FROM outcome""",
    ),
    "review_list": _q(
        DECIDED, "SELECT source_file, n_issues FROM outcome WHERE outcome = 'needs_review'"
    ),
    "failed_list": _q(
        DECIDED, "SELECT source_file, reason FROM outcome WHERE outcome = 'failed'"
    ),
    "dedup_batch": _q(
        DECIDED, "SELECT source_file, invoice_number, is_first FROM decided WHERE reason IS NULL"
    ),
    "dedup_stored": _q(
        f"""{DECIDED},
           taken AS (SELECT DISTINCT invoice_number FROM assessed WHERE reason IS NULL AND k % 3 = 0)""",
        """SELECT source_file,
             CASE WHEN reason IS NULL AND is_first AND NOT known THEN 'stored' ELSE 'failed' END AS outcome,
             CASE WHEN reason IS NOT NULL THEN reason WHEN is_first AND NOT known THEN ''
                  ELSE 'Unexpected error: UNIQUE constraint failed: invoices.invoice_number' END AS reason
           FROM (SELECT *, invoice_number IN (SELECT invoice_number FROM taken) AS known FROM decided)""",
    ),
    "orphan_audit": _q(
        DECIDED,
        """SELECT source_file, CAST(pos AS INTEGER) AS position FROM reported
           WHERE k NOT IN (SELECT k FROM stored)""",
    ),
    "not_null_audit": _q(
        DOCUMENTS,
        """SELECT count(*) - count(invoice_number) AS invoice_number,
             count(*) - count(invoice_date) AS invoice_date, count(*) - count(vendor_name) AS vendor_name,
             count(*) - count(total_amount) AS total_amount, count(*) - count(mean_conf) AS confidence_score,
             count(*) - count(source_file) AS source_file FROM header""",
    ),
    "joined_lists": _q(
        DECIDED,
        f"""SELECT source_file, {_joined("warnings")} AS extraction_warnings,
              {_joined("issues")} AS validation_issues FROM stored""",
    ),
    "text_rendering": _q(
        DECIDED,
        """SELECT source_file, invoice_number, CAST(invoice_date AS VARCHAR) AS invoice_date,
             CAST(due_date AS VARCHAR) AS due_date,
             CAST(CAST(subtotal AS DECIMAL(18,6)) AS VARCHAR) AS subtotal,
             CAST(CAST(vat_amount AS DECIMAL(18,6)) AS VARCHAR) AS vat_amount,
             CAST(CAST(total_amount AS DECIMAL(18,6)) AS VARCHAR) AS total_amount FROM stored""",
    ),
    "triage": _q(
        TRIAGE,
        """SELECT source_file, reason = 'OK' AS is_valid,
             CASE WHEN reason IN ('OK', 'PDF is password protected') THEN n_pages ELSE 0 END AS page_count,
             reason = 'OK' AND any_text AS has_text_layer, reason FROM files""",
    ),
    "triage_counts": _q(
        TRIAGE,
        """SELECT count(*) AS n_files, count(*) FILTER (WHERE reason = 'OK') AS n_valid,
             count(*) FILTER (WHERE reason <> 'OK') AS n_invalid FROM files""",
    ),
    "text_layer": _q(
        TRIAGE,
        """SELECT source_file, CAST(before // 1048576 AS INTEGER) AS segment, min(before) AS start, count(*) AS n_pages,
             string_agg(page, '' ORDER BY n) AS text, bool_or(trim(page) <> '') AS segment_has_text
           FROM (SELECT source_file, page, row_number() OVER pages AS n,
                   CAST(coalesce(sum(length(page)) OVER (pages ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
                 FROM (SELECT source_file, c, turn, CASE WHEN c % 7 = 0 THEN '   ' ELSE text END AS page
                       FROM files JOIN conversations ON conv_id = c WHERE reason = 'OK')
                 WINDOW pages AS (PARTITION BY c ORDER BY turn, page))
           GROUP BY 1, 2""",
    ),
    "german_amount": f"SELECT o_orderkey AS order_key, {GERMAN} AS amount_text FROM orders",
    "date_rendering": """
        SELECT o_orderkey AS order_key, CASE o_orderkey % 3
                 WHEN 0 THEN strftime(o_orderdate, '%d.%m.%Y')
                 WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
                 ELSE strftime(o_orderdate, '%d/%m/%Y') END AS date_text
        FROM orders""",
    "due_date_rule": """
        SELECT o_orderkey AS order_key, CAST(due AS VARCHAR) AS due_date, due < d AS is_early
        FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, make_date(year(o_orderdate),
                month(o_orderdate), least(day(o_orderdate) + 14, 28)) AS due FROM orders)""",
    "locale_values": """
        SELECT o_orderkey AS order_key,
               CASE WHEN o_orderkey % 17 <> 0 AND o_orderkey % 5 <> 2
                    THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE)
                         * CASE WHEN o_orderkey % 5 = 4 THEN -1 ELSE 1 END END AS amount,
               CASE WHEN o_orderkey % 19 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day
        FROM orders""",
    "item_constraints": f"""
        SELECT k AS order_key, position, 'Line item ' || position || ': ' || array_to_string(found, ', ') AS reason
        FROM (SELECT l_orderkey AS k, l_linenumber AS position, {_kept(
            "CASE WHEN l_orderkey % 3 = 0 THEN 'description is empty' END",
            "CASE WHEN l_orderkey % 5 <> 0 AND l_orderkey % 7 = 0 THEN 'quantity is not a number' END",
            "CASE WHEN l_orderkey % 5 = 0 THEN 'quantity is missing' END",
            "CASE WHEN l_orderkey % 5 <> 0 AND l_orderkey % 7 <> 0 AND l_orderkey % 11 = 0 "
            "THEN 'quantity is not greater than 0' END",
            "CASE WHEN l_orderkey % 13 = 0 THEN 'amount is out of range' END")} AS found FROM lineitem)
        WHERE len(found) > 0""",
    "review_queue": _q(
        DECIDED,
        f"""SELECT source_file, invoice_number, {_joined("issues")} AS validation_issues
            FROM stored WHERE status = 'needs_review'""",
    ),
    "review_rate": _q(
        DECIDED,
        """SELECT count(*) AS n_invoices, count(*) FILTER (WHERE status = 'needs_review') AS n_flagged,
             round(avg(CASE WHEN status = 'needs_review' THEN 1.0 ELSE 0.0 END), 6) AS review_rate,
             round(avg(score), 6) AS mean_confidence FROM stored""",
    ),
    "completeness": _q(
        DOCUMENTS,
        """SELECT count(*) AS n_documents,
             round(count(invoice_number) / count(*), 6) AS share_invoice_number,
             round(count(invoice_date) / count(*), 6) AS share_invoice_date,
             round(count(vendor_name) / count(*), 6) AS share_vendor_name,
             round(count(total_amount) / count(*), 6) AS share_total_amount,
             round(count(vendor_name || total_amount) / count(*), 6) AS share_complete FROM header""",
    ),
    "calendar_rollup": _q(
        DECIDED,
        """SELECT CAST(year(invoice_date) AS INTEGER) AS year, CAST(quarter(invoice_date) AS INTEGER) AS quarter,
             CAST(month(invoice_date) AS INTEGER) AS month, count(*) AS n_invoices,
             CAST(sum(total_amount) AS DOUBLE) AS total_amount,
             count(*) FILTER (WHERE status = 'needs_review') AS n_flagged
           FROM stored GROUP BY 1, 2, 3""",
    ),
    "report_row": _q(
        DECIDED,
        """SELECT source_file, invoice_number, CAST(trunc(score * 100) AS INTEGER) AS confidence_percent,
             CASE WHEN trunc(score * 100) >= 80 THEN 'high' WHEN trunc(score * 100) >= 60 THEN 'medium'
                  ELSE 'low' END AS confidence_band,
             CASE status WHEN 'valid' THEN 'Valid' ELSE 'Needs Review' END AS status_label FROM stored""",
    ),
    "report_amounts": _q(
        DECIDED,
        f"""SELECT source_file, strftime(invoice_date, '%d %b %Y') AS invoice_date,
             coalesce(strftime(due_date, '%d %b %Y'), '—') AS due_date, vendor_name, vendor_address,
             coalesce(vendor_tax_id, '—') AS vendor_tax_id, '—' AS vendor_iban,
             coalesce(customer_name, '—') AS customer_name,
             coalesce(customer_address, '—') AS customer_address, {EURO.format("subtotal")} AS subtotal,
             {EURO.format("vat_amount")} AS vat_amount,
             coalesce('(' || CAST(trunc(vat_rate * 100) AS INTEGER) || '%)', '') AS vat_rate,
             {EURO.format("total_amount")} AS total_amount FROM stored""",
    ),
    "report_items": _q(
        DECIDED,
        """SELECT source_file, CAST(pos AS INTEGER) AS position, description,
             printf('%g', CAST(qty AS DOUBLE)) AS quantity,
             '€ ' || format('{:,.2f}', unit_price_2) AS unit_price,
             '€ ' || format('{:,.2f}', line_total) AS line_total
           FROM (SELECT *, round_even(CAST(unit_price AS DECIMAL(18,10)), 2) AS unit_price_2 FROM judged)
           WHERE NOT is_skipped AND k IN (SELECT k FROM stored)""",
    ),
    "findings_list": _q(
        DECIDED,
        """SELECT source_file, CAST(seq AS INTEGER) AS seq,
             CASE WHEN n = 0 THEN 'none' WHEN seq <= len(warnings) THEN 'warning' ELSE 'issue' END AS kind,
             CASE WHEN n = 0 THEN 'No warnings or issues found'
                  ELSE list_concat(warnings, issues)[seq] END AS finding
           FROM (SELECT *, unnest(range(1, greatest(n, 1) + 1)) AS seq
                 FROM (SELECT *, len(warnings) + len(issues) AS n FROM stored))""",
    ),
    "stored_items": _q(
        RUNS,
        f"""SELECT run_id, sha256(invoice_number) AS invoice_id, CAST(pos AS INTEGER) AS position, description,
              CAST(qty AS DOUBLE) AS quantity, round(unit_price, 8) AS unit_price,
              CAST(line_total AS DOUBLE) AS line_total
            FROM judged JOIN kept ON kept.k = judged.k WHERE NOT is_skipped""",
    ),
    "write_audit": _q(
        f"""{RUNS},
            invoices AS (SELECT *, sha256(invoice_number) AS invoice_id FROM kept),
            items AS (SELECT judged.*, invoice_id FROM judged JOIN invoices ON invoices.k = judged.k WHERE NOT is_skipped)""",
        " UNION ALL ".join(
            [
                f"SELECT '{kind}' AS kind, '{name}' AS metric, CAST({value} AS BIGINT) AS value FROM {source}"
                for kind, name, value, source in (
                    ("run", "total_files", "count(*)", "all_files"),
                    ("run", "valid", "count(*) FILTER (WHERE status = 'valid')", "kept"),
                    ("run", "needs_review", "count(*) FILTER (WHERE status = 'needs_review')", "kept"),
                    ("run", "failed", "(SELECT count(*) FROM all_files) - count(*)", "kept"),
                    ("run", "invoices", "count(*)", "invoices"),
                    ("items", "line_items", "count(*)", "items"),
                    *(("run", f"invoices.{n} is null", f"count(*) - count({c})", "invoices") for n, c in (
                        ("invoice_number", "invoice_number"), ("invoice_date", "invoice_date"),
                        ("vendor_name", "vendor_name"), ("total_amount", "total_amount"),
                        ("confidence_score", "score"), ("validation_status", "status"), ("source_file", "source_file"))),
                    *(("items", f"line_items.{n} is null", f"count(*) - count({c})", "items") for n, c in (
                        ("invoice_id", "invoice_id"), ("position", "pos"), ("description", "description"),
                        ("quantity", "qty"), ("unit_price", "unit_price"), ("line_total", "line_total"))),
                )
            ]
        ),
    ),
    "retried_rejects": _q(
        f"""{DOCUMENTS},
            runs AS (SELECT *, CASE WHEN k % 53 = 0 AND k % 151 <> 0 THEN 'again' ELSE 'first' END AS run_id FROM assessed),
            {WINNERS}""",
        f"""SELECT run_id, source_file, CASE WHEN won THEN status ELSE 'failed' END AS outcome,
               CASE WHEN reason IS NOT NULL THEN reason WHEN won THEN '' ELSE '{TAKEN}' END AS reason
            FROM run_outcomes""",
    ),
    "arrival_stream": _q(
        f"""{DOCUMENTS},
            timed AS (
              SELECT a.*, o_orderdate AS file_time, k % 53 <> 0 AS has_response,
                     CASE WHEN k % 53 <> 0 THEN o_orderdate + to_hours(CAST(k % 20 AS INTEGER)) + INTERVAL 30 MINUTE END AS response_time
              FROM assessed a JOIN orders ON o_orderkey = k),
            mark AS (SELECT least(max(file_time), max(response_time)) - INTERVAL 5 HOUR AS watermark FROM timed),
            seen AS (
              SELECT * REPLACE (CASE
                       WHEN k % 151 = 0 THEN reason
                       WHEN k % 149 = 0 THEN 'Preprocessing failed: Could not open file - it may be corrupted: no %PDF- signature'
                       WHEN k % 163 = 0 THEN 'Preprocessing failed: PDF has no pages'
                       WHEN k % 157 = 0 THEN 'Preprocessing failed: PDF is password protected'
                       WHEN NOT has_response THEN 'Extraction failed: no analysis response was recorded for this file'
                       ELSE reason END AS reason)
              FROM timed, mark WHERE has_response OR file_time + INTERVAL 37 HOUR < watermark),
            runs AS (SELECT *, 'one' AS run_id FROM seen), {WINNERS}""",
        f"""SELECT source_file, CASE WHEN won THEN status ELSE 'failed' END AS outcome,
               CASE WHEN reason IS NOT NULL THEN reason WHEN won THEN '' ELSE '{TAKEN}' END AS reason,
               CASE WHEN won THEN len(issues) ELSE 0 END AS n_issues
            FROM run_outcomes""",
    ),
}

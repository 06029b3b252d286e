"""DuckDB SQL that states each query's expected result independently.

These texts run in DuckDB over the pre-registered driver tables and must
produce the same multiset of rows, column names and types as the Spark
query of the same key. They are written from the rules, not generated from
the Spark plans, so the two sides check each other.

DuckDB differences handled here: ``TRY_CAST('2.7' AS INTEGER)`` rounds (strip
the fraction first), ``try_strptime`` is lenient about digit counts (guard
with a full match), ``1.0`` is DECIMAL (write ``1.0::DOUBLE``), ``sum`` of
BIGINT is HUGEINT (cast back), and window orders need ``NULLS FIRST``.
"""

from __future__ import annotations

from argent.plans.bronze import bronze_customers_sql, bronze_sales_sql

# Fixed values (same lists as the Spark rules).
_CATEGORY_LIST = (
    "'CLOTHING', 'SHOES', 'BOOKS', 'COSMETICS', 'FOOD & BEVERAGE', 'ELECTRONICS', 'ACCESSORIES'"
)
_GENDER_LIST = "'MALE', 'FEMALE'"


def _int_from_text(x: str) -> str:
    # A fraction right after the digits is dropped; a bare fraction is 0.
    ws = r"[\x00-\x20]"
    return (
        rf"CASE WHEN regexp_full_match({x}, '{ws}*[+-]?\.\d*{ws}*') THEN 0 "
        rf"ELSE TRY_CAST(regexp_replace({x}, '^({ws}*[+-]?\d+)\.\d*({ws}*)$', '\1\2') AS INTEGER) END"
    )


def _strict_date(x: str) -> str:
    return (
        rf"CASE WHEN regexp_full_match({x}, '\d{{2}}-\d{{2}}-\d{{4}}') "
        rf"THEN CAST(try_strptime({x}, '%d-%m-%Y') AS DATE) END"
    )


def _date_from_text(x: str, parse_first: bool = True) -> str:
    cast = f"TRY_CAST({x} AS DATE)"
    return f"coalesce({_strict_date(x)}, {cast})" if parse_first else cast


def _std(x: str, values: str) -> str:
    return f"CASE WHEN upper(trim({x})) IN ({values}) THEN upper(trim({x})) ELSE 'Other' END"


def _strip(x: str) -> str:
    return rf"regexp_replace(trim({x}), '[^a-zA-Z0-9\s]', '', 'g')"


def _fill(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN 'Unknown' ELSE {x} END"


# --- customers -------------------------------------------------------------

def _numbered(bronze: str, also: str) -> str:
    """The bronze rows, with a number if it is among the columns carried along."""
    return f"SELECT row_number() OVER () AS rid, * FROM ({bronze}) b" if also else bronze


def customer_conformed_cte(also: str = "") -> str:
    return f"""bronze AS ({_numbered(bronze_customers_sql(), also)}),
conformed AS (
  SELECT customer_id, gender, {_int_from_text('age')} AS age, payment_method{also} FROM bronze)"""


def customer_cleaned_cte(also: str = "") -> str:
    return f"""{customer_conformed_cte(also)},
trimmed AS (
  SELECT trim(customer_id) AS customer_id, trim(gender) AS gender, age,
         trim(payment_method) AS payment_method{also} FROM conformed),
filled AS (
  SELECT customer_id, {_fill('gender')} AS gender, coalesce(age, 0) AS age,
         {_fill('payment_method')} AS payment_method{also} FROM trimmed),
cleaned AS (
  SELECT customer_id{also}, {_std('gender', _GENDER_LIST)} AS gender,
         CASE WHEN age IS NULL OR age < 0 OR age > 120 THEN 0 ELSE age END AS age,
         payment_method,
         NOT (upper(trim(gender)) IN ({_GENDER_LIST})) AS bad_gender,
         (age IS NULL OR age < 0 OR age > 120) AS bad_age
  FROM filled),
deduped AS (
  SELECT customer_id, gender, age, payment_method FROM cleaned
  QUALIFY row_number() OVER (PARTITION BY customer_id
    ORDER BY gender NULLS FIRST, age NULLS FIRST, payment_method NULLS FIRST) = 1)"""


CUSTOMER_VALID = "(customer_id IS NOT NULL AND customer_id <> '' AND trim(customer_id) <> '')"


def customer_pipeline() -> str:
    return f"WITH {customer_cleaned_cte()}\nSELECT * FROM deduped WHERE {CUSTOMER_VALID}"


def customer_quality() -> str:
    return f"""WITH {customer_cleaned_cte()}
SELECT
  (SELECT count(*) FROM cleaned) AS rows_in,
  (SELECT count(*) FILTER (WHERE bad_gender) FROM cleaned) AS invalid_genders,
  (SELECT count(*) FILTER (WHERE bad_age) FROM cleaned) AS invalid_ages,
  (SELECT count(*) FROM cleaned) - (SELECT count(*) FROM deduped) AS duplicates_removed,
  (SELECT count(*) FILTER (WHERE NOT coalesce({CUSTOMER_VALID}, false)) FROM deduped) AS invalid_customers,
  (SELECT count(*) FILTER (WHERE {CUSTOMER_VALID}) FROM deduped) AS rows_out"""


# --- sales -----------------------------------------------------------------

def sales_conformed_cte(parse_first: bool = True, also: str = "") -> str:
    return f"""bronze AS ({_numbered(bronze_sales_sql(), also)}),
conformed AS (
  SELECT invoice_no, customer_id, category, {_int_from_text('quantity')} AS quantity,
         TRY_CAST(price AS DOUBLE) AS price,
         {_date_from_text('invoice_date', parse_first)} AS invoice_date,
         shopping_mall{also} FROM bronze)"""


def sales_cleaned_cte(parse_first: bool = True, also: str = "", valid_first: bool = False) -> str:
    lead = f"coalesce({SALES_VALID}, false) DESC, " if valid_first else ""
    return f"""{sales_conformed_cte(parse_first, also)},
trimmed AS (
  SELECT trim(invoice_no) AS invoice_no, trim(customer_id) AS customer_id, trim(category) AS category,
         quantity, price, invoice_date, trim(shopping_mall) AS shopping_mall{also} FROM conformed),
filled AS (
  SELECT invoice_no, customer_id, {_fill('category')} AS category,
         coalesce(CAST(quantity AS DOUBLE), 0.0::DOUBLE) AS quantity,
         CASE WHEN price IS NULL OR isnan(price) THEN 0.0::DOUBLE ELSE price END AS price,
         invoice_date, {_fill('shopping_mall')} AS shopping_mall{also} FROM trimmed),
cleaned AS (
  SELECT invoice_no, customer_id{also}, {_std('category', _CATEGORY_LIST)} AS category,
         CASE WHEN quantity <= 0 THEN 1.0::DOUBLE ELSE quantity END AS quantity,
         CASE WHEN price < 0 THEN 0.0::DOUBLE ELSE price END AS price,
         invoice_date, {_strip('shopping_mall')} AS shopping_mall,
         invoice_date IS NULL AS null_date,
         quantity <= 0 AS bad_quantity,
         price < 0 AS bad_price,
         NOT (upper(trim(category)) IN ({_CATEGORY_LIST})) AS bad_category
  FROM filled),
deduped AS (
  SELECT invoice_no, customer_id, category, quantity, price, invoice_date, shopping_mall FROM cleaned
  QUALIFY row_number() OVER (PARTITION BY invoice_no
    ORDER BY {lead}customer_id NULLS FIRST, category NULLS FIRST, quantity NULLS FIRST, price NULLS FIRST,
             invoice_date NULLS FIRST, shopping_mall NULLS FIRST) = 1)"""


SALES_VALID = (
    "(invoice_no IS NOT NULL AND invoice_no <> '' AND customer_id IS NOT NULL AND customer_id <> '' "
    "AND quantity IS NOT NULL AND price IS NOT NULL)"
)


def sales_pipeline(parse_first: bool = True, valid_first: bool = False) -> str:
    return f"WITH {sales_cleaned_cte(parse_first, valid_first=valid_first)}\nSELECT * FROM deduped WHERE {SALES_VALID}"


def sales_pipeline_valid_first() -> str:
    return sales_pipeline(valid_first=True)


def sales_quality_valid_first() -> str:
    return sales_quality(valid_first=True)


def sales_split_silver() -> str:
    return sales_pipeline()


def _rejects(cleaned: str, keys: str, columns: str, flags: dict[str, str], valid: str, invalid_name: str) -> str:
    """Bronze rows with the names of all counters that count them. The kept row
    of a key is the first by the cleaned columns, then by those it came with."""
    order = ", ".join(f"{t}.{c} NULLS FIRST" for t in ("c", "b") for c in columns.split(", ") if (t, c) != ("c", keys))
    named = "".join(f"CASE WHEN {f} THEN '{name}' END, " for name, f in flags.items())
    return f"""WITH {cleaned},
judged AS (
  SELECT c.*, row_number() OVER (PARTITION BY c.{keys} ORDER BY {order}) AS nth FROM cleaned c JOIN bronze b ON c.rid = b.rid),
reasoned AS (
  SELECT rid, concat_ws(',', {named}CASE WHEN nth > 1 THEN 'duplicates_removed'
    WHEN NOT coalesce({valid}, false) THEN '{invalid_name}' END) AS reasons FROM judged)
SELECT {columns}, reasons FROM bronze JOIN reasoned ON bronze.rid = reasoned.rid WHERE reasons <> ''"""


def customer_rejects() -> str:
    flags = {"invalid_genders": "bad_gender", "invalid_ages": "bad_age"}
    columns = "customer_id, gender, age, payment_method"
    return _rejects(customer_cleaned_cte(", rid"), "customer_id", columns, flags, CUSTOMER_VALID, "invalid_customers")


def sales_rejects() -> str:
    flags = {"null_invoice_dates": "null_date", "invalid_quantities": "bad_quantity", "invalid_prices": "bad_price", "invalid_categories": "bad_category"}
    columns = ", ".join(_SALES_TEXT_COLS)
    return _rejects(sales_cleaned_cte(also=", rid"), "invoice_no", columns, flags, SALES_VALID, "invalid_sales")


def sales_quality(valid_first: bool = False) -> str:
    return f"""WITH {sales_cleaned_cte(valid_first=valid_first)}
SELECT
  (SELECT count(*) FROM cleaned) AS rows_in,
  (SELECT count(*) FROM cleaned) - (SELECT count(*) FROM deduped) AS duplicates_removed,
  (SELECT count(*) FILTER (WHERE null_date) FROM cleaned) AS null_invoice_dates,
  (SELECT count(*) FILTER (WHERE bad_quantity) FROM cleaned) AS invalid_quantities,
  (SELECT count(*) FILTER (WHERE bad_price) FROM cleaned) AS invalid_prices,
  (SELECT count(*) FILTER (WHERE bad_category) FROM cleaned) AS invalid_categories,
  (SELECT count(*) FILTER (WHERE NOT coalesce({SALES_VALID}, false)) FROM deduped) AS invalid_sales,
  (SELECT count(*) FILTER (WHERE {SALES_VALID}) FROM deduped) AS rows_out"""


def sales_pipeline_observed() -> str:
    return sales_pipeline()


# --- single rules ----------------------------------------------------------

def _with(cte: str, select: str) -> str:
    return f"WITH {cte}\n{select}"


def conform_customer() -> str:
    return _with(customer_conformed_cte(), "SELECT * FROM conformed")


def conform_sales() -> str:
    return _with(sales_conformed_cte(), "SELECT * FROM conformed")


_SALES_TEXT_COLS = ("invoice_no", "customer_id", "category", "quantity", "price",
                    "invoice_date", "shopping_mall")


def trim_strings() -> str:
    cols = ", ".join(f"trim({c}) AS {c}" for c in _SALES_TEXT_COLS)
    return f"SELECT {cols} FROM ({bronze_sales_sql()}) b"


def fill_missing_strings() -> str:
    return (f"SELECT invoice_no, customer_id, {_fill('category')} AS category, quantity, price, "
            f"invoice_date, {_fill('shopping_mall')} AS shopping_mall FROM ({bronze_sales_sql()}) b")


def fill_missing_numerics() -> str:
    return _with(sales_conformed_cte(), (
        "SELECT invoice_no, customer_id, category, "
        "coalesce(CAST(quantity AS DOUBLE), 0.0::DOUBLE) AS quantity, "
        "CASE WHEN price IS NULL OR isnan(price) THEN 0.0::DOUBLE ELSE price END AS price, "
        "invoice_date, shopping_mall FROM conformed"))


def _trimmed_sales() -> str:
    cols = ", ".join(f"trim({c}) AS {c}" for c in _SALES_TEXT_COLS)
    return f"trimmed AS (SELECT {cols} FROM ({bronze_sales_sql()}) b)"


def dedup_by_key() -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in _SALES_TEXT_COLS if c != "invoice_no")
    return _with(_trimmed_sales(), (
        "SELECT * FROM trimmed QUALIFY row_number() OVER "
        f"(PARTITION BY invoice_no ORDER BY {order}) = 1"))


def dedup_rows() -> str:
    return _with(_trimmed_sales(), "SELECT DISTINCT * FROM trimmed")


def customer_gender() -> str:
    return _with(customer_conformed_cte(), (
        f"SELECT customer_id, {_std('gender', _GENDER_LIST)} AS gender, age, payment_method "
        "FROM conformed"))


def customer_age() -> str:
    return _with(customer_conformed_cte(), (
        "SELECT customer_id, gender, CASE WHEN age IS NULL OR age < 0 OR age > 120 THEN 0 "
        "ELSE age END AS age, payment_method FROM conformed"))


def customer_names() -> str:
    return f"SELECT * REPLACE ({_strip('c_name')} AS c_name) FROM customer"


def customer_validate() -> str:
    return _with(customer_conformed_cte(), f"SELECT * FROM conformed WHERE {CUSTOMER_VALID}")


def sales_invoice_date() -> str:
    return (f"SELECT invoice_no, customer_id, category, quantity, price, "
            f"{_strict_date('invoice_date')} AS invoice_date, shopping_mall "
            f"FROM ({bronze_sales_sql()}) b")


def sales_invoice_date_cast_first() -> str:
    return _with(sales_conformed_cte(parse_first=False), "SELECT * FROM conformed")


def sales_numeric_fields() -> str:
    return _with(sales_conformed_cte(), (
        "SELECT invoice_no, customer_id, category, "
        "CASE WHEN quantity <= 0 THEN 1 ELSE quantity END AS quantity, "
        "CASE WHEN price < 0 THEN 0.0::DOUBLE ELSE price END AS price, "
        "invoice_date, shopping_mall FROM conformed"))


def sales_category() -> str:
    return (f"SELECT invoice_no, customer_id, {_std('category', _CATEGORY_LIST)} AS category, "
            f"quantity, price, invoice_date, shopping_mall FROM ({bronze_sales_sql()}) b")


def sales_mall_names() -> str:
    return (f"SELECT invoice_no, customer_id, category, quantity, price, invoice_date, "
            f"{_strip('shopping_mall')} AS shopping_mall FROM ({bronze_sales_sql()}) b")


def sales_validate() -> str:
    return _with(sales_conformed_cte(), f"SELECT * FROM conformed WHERE {SALES_VALID}")


def agg_total_quantity() -> str:
    return "SELECT sum(l_quantity) AS total_quantity FROM lineitem"


def filter_product() -> str:
    return "SELECT * FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus IN ('O', 'F')"


# --- sources ---------------------------------------------------------------

_CUSTOMER_TEXT_COLS = ("customer_id", "gender", "age", "payment_method", "extra_col")


def _nullif_all(cols, src: str, rename=None) -> str:
    names = rename or cols
    body = ", ".join(f"nullif({c}, '') AS {n}" for c, n in zip(cols, names))
    return f"SELECT {body} FROM ({src}) b"


def csv_scan_strings() -> str:
    # The CSV writer writes NULL and '' alike; both read back as NULL.
    return _nullif_all(_SALES_TEXT_COLS, bronze_sales_sql())


def csv_scan_delimited() -> str:
    return _nullif_all(_CUSTOMER_TEXT_COLS, bronze_customers_sql())


def csv_scan_no_header() -> str:
    return _nullif_all(_SALES_TEXT_COLS, bronze_sales_sql(),
                       [f"_c{i}" for i in range(len(_SALES_TEXT_COLS))])


def csv_scan_inferred() -> str:
    return ("SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, "
            "p_size, p_retailprice FROM part")


def csv_scan_schema() -> str:
    return "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"


QUOTED_NAME = "p_name"
QUOTED_DESCRIPTION = "p_brand || ', \"' || p_type || '\"'"
QUOTED_NOTES = "'size ' || CAST(p_size AS VARCHAR) || ', \"boxed\"'"


def csv_scan_quoted() -> str:
    return (f"SELECT {QUOTED_NAME} AS name, {QUOTED_DESCRIPTION} AS description, "
            f"{QUOTED_NOTES} AS notes FROM part")


def csv_scan_permissive() -> str:
    line = ("CASE p_partkey % 10 WHEN 0 THEN CAST(p_partkey AS VARCHAR) || ',' || p_name "
            "WHEN 1 THEN CAST(p_partkey AS VARCHAR) || ',' || p_name || ',' || CAST(p_size AS VARCHAR) || ',extra' "
            "ELSE CAST(p_partkey AS VARCHAR) || ',' || p_name || ',' || CAST(p_size AS VARCHAR) END")
    return ("SELECT p_partkey AS id, p_name AS name, "
            "CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_size END AS size, "
            f"CASE WHEN p_partkey % 10 IN (0, 1) THEN {line} END AS _corrupt_record FROM part")


def _routed_lines() -> str:
    """Part rows as the lines they were written as, and whether they fit."""
    return """SELECT *, CASE p_partkey % 10 WHEN 0 THEN CAST(p_partkey AS VARCHAR) || ',' || p_name
   WHEN 1 THEN CAST(p_partkey AS VARCHAR) || ',' || p_name || ',' || CAST(p_size AS VARCHAR) || ',extra'
   WHEN 2 THEN CAST(p_partkey AS VARCHAR) || ',' || p_name || ',big' END AS bad_line FROM part"""


def csv_good_records() -> str:
    return f"SELECT p_partkey AS id, p_name AS name, p_size AS size FROM ({_routed_lines()}) l WHERE bad_line IS NULL"


def csv_bad_records() -> str:
    return f"""SELECT CAST(p_partkey % 2 AS VARCHAR) AS feed, true AS named, bad_line AS line, p_partkey AS id
FROM ({_routed_lines()}) l WHERE bad_line IS NOT NULL"""


def parquet_scan() -> str:
    return "SELECT * FROM orders"


def parquet_scan_schema() -> str:
    return ("SELECT o_orderkey, o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_comment "
            "FROM orders")


def parquet_scan_merge_schema() -> str:
    return ("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders UNION ALL BY NAME "
            "SELECT * EXCLUDE (o_custkey, o_orderstatus) FROM orders")


def nested_scan() -> str:
    return ("SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dims, "
            "embedding[1] AS first_value, embedding[-1] AS last_value FROM embeddings")


def nested_map_scan() -> str:
    return ("SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority, "
            "2 AS n_keys FROM orders")


def timestamp_parse() -> str:
    return ("SELECT *, strptime(ts_text, '%Y-%m-%d %H:%M:%S') AS parsed FROM "
            "(SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM events) e")


def validated_scan() -> str:
    return "SELECT * FROM customer"


def csv_validated_scan() -> str:
    return "SELECT * FROM customer"


# --- sinks -----------------------------------------------------------------

def sink_path() -> str:
    return sales_pipeline()


def sink_append() -> str:
    return (f"SELECT * FROM ({customer_pipeline()}) a\nUNION ALL\n"
            f"SELECT * FROM ({customer_pipeline()}) b")


def sink_ignore() -> str:
    return customer_pipeline()


def sink_partition_overwrite() -> str:
    return f"""SELECT * REPLACE (CASE WHEN category IN ('BOOKS', 'SHOES') THEN price * 2 ELSE price END AS price)
FROM ({sales_pipeline()}) s"""


def sink_keyed_table() -> str:
    return dedup_by_key()


def sink_table() -> str:
    return customer_pipeline()


def bronze_to_silver() -> str:
    # Sales are staged as CSV, where '' reads back as NULL; neither survives
    # the id filter, and both are filled or standardised alike elsewhere.
    return (f"SELECT 'customers' AS silver_table, * FROM ({customer_pipeline()}) c "
            f"UNION ALL BY NAME SELECT 'sales' AS silver_table, * FROM ({sales_pipeline()}) s")


def bronze_to_silver_counters() -> str:
    staged = _nullif_all(_SALES_TEXT_COLS, bronze_sales_sql())  # as CSV gives it back
    reports = {"customers": customer_quality(), "sales": sales_quality().replace(bronze_sales_sql(), staged)}
    return " UNION ALL ".join(
        f"SELECT '{name}' AS silver_table, counter, value FROM (UNPIVOT ({report}) ON COLUMNS(*) INTO NAME counter VALUE value) u"
        for name, report in reports.items()
    )

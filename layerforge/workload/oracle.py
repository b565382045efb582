"""The same results in ANSI-style SQL, as text for an independent engine."""

from __future__ import annotations

from layerforge.workload.roles import AS_OF, TAXONOMY

STAMP = f"TIMESTAMP '{AS_OF}'"
AUDIT = f"TRUE AS is_active, {STAMP} AS created_at, {STAMP} AS updated_at"


# ---------------------------------------------------------------- hashed keys
# Murmur3 over 32-bit words with products masked to 32 bits. the
# published constants of the hash, and the seed 42.

_MASK = 4294967295


def _let(value: str, name: str, body: str) -> str:
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def _times(a: str, c: int) -> str:
    return f"CAST((CAST({a} AS HUGEINT) * {c}) & {_MASK} AS BIGINT)"


def _rotl(x: str, n: int) -> str:
    return f"((({x} << {n}) & {_MASK}) | ({x} >> {32 - n}))"


def _mixed_word(k: str) -> str:
    return _times(_let(_times(k, 0xCC9E2D51), "m", _rotl("m", 15)), 0x1B873593)


def _mixed_hash(h: str, k: str) -> str:
    return f"(({_let(f'xor({h}, {k})', 'x', _rotl('x', 13))} * 5 + {0xE6546B64}) & {_MASK})"


def _final(h: str, length: str) -> str:
    a = _let(f"xor({h}, {length})", "a", _times("xor(a, a >> 16)", 0x85EBCA6B))
    b = _let(a, "b", _times("xor(b, b >> 13)", 0xC2B2AE35))
    return _let(b, "c", "xor(c, c >> 16)")


def _hash(words: str, length: str, seed: str = "42") -> str:
    mixed = f"list_transform({words}, lambda k: {_mixed_word('k')})"
    chained = f"list_reduce(list_prepend(CAST({seed} AS BIGINT), {mixed}), lambda h, k: {_mixed_hash('h', 'k')})"
    return _final(chained, length)


def _hash_int(v: str, seed: str = "42") -> str:
    return _hash(f"[CAST({v} AS BIGINT) & {_MASK}]", "4", seed)


def _hash_bigint(v: str) -> str:
    return _hash(f"[{v} & {_MASK}, ({v} >> 32) & {_MASK}]", "8")


def _hash_text(s: str, seed: str = "42") -> str:
    """ASCII text: little-endian words of four characters, then single characters."""
    full = f"CAST(floor(length({s}) / 4) AS BIGINT)"

    def at(i: str) -> str:
        return f"CAST(ord(substr({s}, CAST({i} AS BIGINT), 1)) AS BIGINT)"

    word = " + ".join(f"{at(f'4 * i + {j + 1}')} * {256**j}" for j in range(4))
    words = (
        f"list_concat(list_transform(range({full}), lambda i: {word}), "
        f"list_transform(range(4 * {full}, length({s})), lambda i: {at('i + 1')}))"
    )
    return _hash(words, f"length({s})", seed)


def _key(h: str) -> str:
    return f"abs({_let(h, 'u', 'CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END')})"


# ----------------------------------------------------------------- input roles


def _initcap(s: str) -> str:
    return (
        f"list_aggregate(list_transform(string_split(lower({s}), ' '), "
        "lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ')"
    )


def _plain_double(s: str) -> str:
    return (
        f"CASE WHEN regexp_matches({s}, '^\\s*-?\\d+(\\.\\d+)?\\s*$') "
        f"THEN TRY_CAST(trim({s}) AS DOUBLE) END"
    )


def _issues(*rules: tuple[str, str]) -> str:
    tags = ", ".join(f"CASE WHEN {bad} THEN '{tag}' END" for tag, bad in rules)
    return f"list_filter([{tags}], lambda x: x IS NOT NULL)"


def _latest(source: str, keys: str, order: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
        f"ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"
    )


_VERSION_TIME = "TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(version AS INTEGER))"

_P = f"""p AS (
  SELECT CASE WHEN k % 101 <> 0 THEN k END AS id,
         CASE WHEN k % 97 = 0 THEN '' ELSE '  ' || p_name || ' ' END AS title,
         CASE WHEN k % 50 = 0 THEN -p_retailprice
              ELSE p_retailprice + version * CAST(1.003 AS DOUBLE) END AS price,
         CASE WHEN k % 37 <> 0 THEN ' made by ' || p_brand END AS description,
         CASE WHEN k % 41 <> 0 THEN ' ' || p_type || ' ' END AS category,
         CASE WHEN k % 43 <> 0 THEN
              CASE WHEN k % 11 = 0 THEN 'ftp' ELSE 'https' END
              || '://img.example.com/' || CAST(k AS VARCHAR) END AS image,
         CAST(p_size AS DOUBLE) / 8 AS rate,
         CAST(p_size - 3 AS INTEGER) AS cnt,
         CASE WHEN NOT (version = 3 AND k % 4 = 0) THEN {_VERSION_TIME} END AS ingestion_ts,
         CAST(version AS INTEGER) AS version
  FROM (SELECT p_partkey AS k, *, unnest(range(1, 2 + p_partkey % 3)) AS version FROM part)
)"""

_TAXONOMY = (
    "CASE category_raw "
    + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in TAXONOMY.items())
    + " END"
)

_PRODUCTS = f"""{_P},
p_flat AS (
  SELECT id, trim(title) AS title, round(price, 2) AS price, trim(description) AS description,
         lower(trim(category)) AS category_raw, image, rate AS rating_rate, cnt AS rating_count,
         ingestion_ts, {STAMP} AS processed_at
  FROM p
),
p_mapped AS (
  SELECT * EXCLUDE (category_raw), {_TAXONOMY} IS NULL AS category_unmapped,
         coalesce({_TAXONOMY}, 'unknown') AS category
  FROM p_flat
),
p_nulled AS (
  SELECT * REPLACE (
    CASE WHEN price < 0 THEN NULL ELSE price END AS price,
    CASE WHEN rating_rate NOT BETWEEN 0 AND 5 THEN NULL ELSE rating_rate END AS rating_rate,
    CASE WHEN rating_count < 0 THEN NULL ELSE rating_count END AS rating_count,
    CASE WHEN NOT regexp_matches(image, '^https?://') THEN NULL ELSE image END AS image)
  FROM p_mapped
),
p_issues AS (
  SELECT *, {_issues(("id_null", "id IS NULL"), ("title_empty", "title IS NULL OR length(title) = 0"),
                     ("price_invalid", "price IS NULL"), ("category_unmapped", "category = 'unknown'"))} AS issues
  FROM p_nulled
),
p_checked AS (
  SELECT * EXCLUDE (issues), coalesce(array_to_string(issues, ','), '') AS dq_issues,
         len(issues) > 0 AS dq_invalid_flag
  FROM p_issues
),
products AS (
  {_latest("(SELECT * FROM p_checked WHERE id IS NOT NULL)", "id",
           "ingestion_ts DESC NULLS LAST, processed_at DESC NULLS LAST")}
)"""


def _degrees(divisor: int) -> str:
    return (
        "CASE WHEN k % 23 = 0 THEN 'n/a' "
        f"ELSE ' ' || CAST(CAST(c_acctbal / {divisor} AS DECIMAL(12,4)) AS VARCHAR) || ' ' END"
    )


_U = f"""u AS (
  SELECT CASE WHEN k % 103 <> 0 THEN k END AS id,
         CASE WHEN k % 29 <> 0 THEN ' ' || CASE WHEN k % 13 = 0 THEN c_name
              ELSE replace(c_name, '#', '.') END || '@Mail.Example.COM ' END AS email,
         CASE WHEN k % 31 = 0 THEN '' WHEN k % 37 <> 0 THEN ' ' || c_name || ' ' END AS username,
         ' +1.570-' || lpad(short, 3, '0') || 'x7033 (ab)' || CAST(version AS VARCHAR) AS phone,
         CAST(version AS INTEGER) AS version,
         CASE WHEN k % 17 <> 0 THEN ' ' || lower(c_mktsegment) || ' ' END AS firstname,
         'mc ' || c_name AS lastname,
         CASE WHEN k % 47 <> 0 THEN '  port ' || n_name || ' ' END AS city,
         ' ' || c_mktsegment || '   high ' || chr(9) || ' st ' AS street,
         CASE WHEN k % 53 <> 0 THEN CAST(k % 500 AS INTEGER) END AS number,
         CASE WHEN k % 19 = 0 THEN NULL WHEN k % 7 = 0 THEN lpad(short, 4, '0')
              WHEN k % 5 = 0 THEN lpad(short, 5, '0') || '-1234 '
              ELSE lpad(short, 5, '0') END AS zipcode,
         {_degrees(50)} AS lat, {_degrees(25)} AS long,
         {_VERSION_TIME} AS ingestion_ts
  FROM (SELECT c_custkey AS k, CAST(c_custkey % 997 AS VARCHAR) AS short, customer.*, n_name,
               unnest(range(1, 2 + c_custkey % 2)) AS version
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)
)"""

_STREET = _initcap(r"regexp_replace(trim(street), '\s+', ' ', 'g')")
_PHONE = r"regexp_replace(trim(phone), '[^\d\-\+\(\)\s]', '', 'g')"

_USERS = f"""{_U},
u_flat AS (
  SELECT id, lower(trim(email)) AS email, lower(trim(username)) AS username, {_PHONE} AS phone,
         {_initcap("trim(firstname)")} AS firstname, {_initcap("trim(lastname)")} AS lastname,
         {_initcap("trim(city)")} AS city, {_STREET} AS street, number,
         upper(trim(zipcode)) AS zipcode,
         {_plain_double("lat")} AS lat, {_plain_double("long")} AS long,
         version AS _v, 'customer' AS file_origin, ingestion_ts, {STAMP} AS processed_at
  FROM u
),
u_flags AS (
  SELECT id, email, username, phone, firstname, lastname,
         concat_ws(' ', firstname, lastname) AS full_name, city, street, number, zipcode,
         concat_ws(', ', street, CAST(number AS VARCHAR)) AS address_line,
         lat, long, _v, file_origin, ingestion_ts, processed_at,
         NOT regexp_matches(email, '^[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{{2,}}$')
           AS dq_email_invalid,
         NOT regexp_matches(zipcode, '^\\d{{5}}(-\\d{{4}})?$') AS dq_zip_invalid,
         NOT ((lat IS NULL OR lat BETWEEN -90 AND 90)
              AND (long IS NULL OR long BETWEEN -180 AND 180)) AS dq_geo_invalid
  FROM u_flat
),
u_issues AS (
  SELECT *, {_issues(("id_null", "id IS NULL"), ("email_invalid", "email IS NULL OR dq_email_invalid"),
                     ("username_empty", "username IS NULL OR length(username) = 0"),
                     ("zipcode_invalid", "dq_zip_invalid"), ("geolocation_invalid", "dq_geo_invalid"))} AS issues
  FROM u_flags
),
u_checked AS (
  SELECT * EXCLUDE (issues), coalesce(array_to_string(issues, ','), '') AS dq_issues,
         len(issues) > 0 AS dq_invalid_flag
  FROM u_issues
),
users AS (
  {_latest("(SELECT * FROM u_checked WHERE id IS NOT NULL)", "id",
           "ingestion_ts DESC NULLS LAST, processed_at DESC NULLS LAST")}
)"""

_RATINGS = """ratings AS (
  SELECT l_partkey AS id,
         CAST(coalesce(CASE WHEN l_linenumber % 2 = 0 THEN l_shipdate END, l_shipdate) AS DATE) AS dt,
         l_orderkey AS order_no, l_extendedprice AS price,
         CASE WHEN l_linenumber <> 7 THEN l_discount * 50 END AS rating_rate,
         CASE WHEN l_tax > 0 THEN CAST(l_quantity AS INTEGER) END AS rating_count
  FROM lineitem
)"""

_FACT = f"""{_RATINGS},
closing AS (
  SELECT id, dt, price, rating_rate FROM ratings
  QUALIFY row_number() OVER (PARTITION BY id, dt ORDER BY order_no DESC, price DESC,
    rating_rate DESC NULLS LAST) = 1
),
totals AS (
  SELECT id, dt, CAST(sum(coalesce(rating_count, 0)) AS BIGINT) AS n FROM ratings GROUP BY id, dt
),
mean AS (SELECT coalesce(avg(rating_rate), 0.0) AS m FROM ratings WHERE dt IS NOT NULL),
counted AS (
  SELECT id, dt, price, rating_rate,
         CAST(sum(n) OVER (PARTITION BY id ORDER BY dt
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum
  FROM closing JOIN totals USING (id, dt) WHERE dt IS NOT NULL
),
fact AS (
  SELECT dt, {_key(_hash_bigint("id"))} AS product_key, id AS product_id, price, rating_rate,
         coalesce(cum - lag(cum) OVER (PARTITION BY id ORDER BY dt), cum) AS rating_count_incremental,
         cum AS rating_count_cum,
         round((20 * m + rating_rate * cum) / (20 + cum), 6) AS rating_bayes_score
  FROM counted CROSS JOIN mean
)"""

_DIM_PRODUCT = f"""dim_category AS (
  SELECT {_key(_hash_text("category"))} AS category_key, category
  FROM (SELECT DISTINCT lower(category) AS category FROM products WHERE category IS NOT NULL)
),
dim_product AS (
  SELECT {_key(_hash_bigint("id"))} AS product_key, id AS product_id, title, description, image,
         category_key, price AS current_price, rating_rate AS current_rating_rate,
         rating_count AS current_rating_count
  FROM products s LEFT JOIN dim_category c ON lower(s.category) = c.category
)"""

_CITY_KEY = _key(
    _let(
        _hash_text("coalesce(city, '')"),
        "first_hash",
        _hash_text("coalesce(zipcode, '')", "first_hash"),
    )
)
_DIM_USER = f"""dim_city AS (
  SELECT {_CITY_KEY} AS city_key, city, zipcode
  FROM (SELECT DISTINCT {_initcap("trim(city)")} AS city, upper(trim(zipcode)) AS zipcode
        FROM users WHERE city IS NOT NULL OR zipcode IS NOT NULL)
),
dim_user AS (
  SELECT {_key(_hash_bigint("id"))} AS user_key, id AS user_id, full_name,
         firstname AS first_name, lastname AS last_name, email, username, phone, city_key,
         lat AS latitude, long AS longitude
  FROM users u LEFT JOIN dim_city c
    ON {_initcap("trim(u.city)")} = c.city AND upper(trim(u.zipcode)) = c.zipcode
)"""

_CATALOG = f"""{_PRODUCTS}, {_DIM_PRODUCT}, {_FACT},
catalog AS (
  SELECT product_id AS id, title, category, current_price, current_rating_rate,
         current_rating_count, rating_bayes_score, image, dt AS last_dt
  FROM dim_product JOIN dim_category USING (category_key)
  JOIN (SELECT product_id, dt, rating_bayes_score FROM fact
        QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY dt DESC) = 1)
  USING (product_id)
)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def oracle_sql() -> dict[str, str]:
    part_pair = _key(
        _let(_hash_text("p_brand"), "first_hash", _hash_text("p_type", "first_hash"))
    )
    summary = " UNION ALL ".join(
        f"SELECT '{e}' AS entity, issue, count(*) AS n_rows FROM "
        f"(SELECT unnest(issues) AS issue FROM {t}) GROUP BY issue"
        for e, t in (("products", "p_issues"), ("users", "u_issues"))
    )
    found = {
        "silver_products": _with(_PRODUCTS, "SELECT * FROM products"),
        "silver_users": _with(_USERS, "SELECT * FROM users"),
        "quarantine_products": _with(
            _PRODUCTS,
            "SELECT * FROM products WHERE dq_invalid_flag "
            "UNION ALL SELECT * FROM p_checked WHERE id IS NULL",
        ),
        "quarantine_users": _with(
            _USERS,
            "SELECT * FROM users WHERE dq_invalid_flag "
            "UNION ALL SELECT * FROM u_checked WHERE id IS NULL",
        ),
        "dq_issue_summary": _with(f"{_PRODUCTS}, {_USERS}", summary),
        "category_taxonomy_map": _with(
            _PRODUCTS, "SELECT id, ingestion_ts, category_unmapped, category FROM p_mapped"
        ),
        "category_taxonomy_join": _with(
            _PRODUCTS,
            """SELECT id, ingestion_ts, mapped IS NULL AS category_unmapped,
                      coalesce(mapped, 'unknown') AS category
               FROM p_flat LEFT JOIN (
                 SELECT DISTINCT lower(p_type) AS t, 'cat_' || lower(p_type) AS mapped
                 FROM part WHERE lower(p_type) <> 'promo') ON category_raw = t""",
        ),
        "safe_double_cast": _with(
            _U,
            f"""SELECT id, version, {_plain_double("lat")} AS lat, {_plain_double("long")} AS long,
                NOT (coalesce({_plain_double("lat")} BETWEEN -90 AND 90, TRUE)
                     AND coalesce({_plain_double("long")} BETWEEN -180 AND 180, TRUE)) AS off_the_globe,
                CAST(NULL AS DOUBLE) AS exponent, CAST(NULL AS DOUBLE) AS plus_sign FROM u""",
        ),
        "text_normalise": _with(
            _U,
            f"""SELECT id, version, lower(trim(email)) AS email,
                {_initcap("trim(firstname)")} AS firstname,
                concat_ws(' ', {_initcap("trim(firstname)")}, {_initcap("trim(lastname)")}) AS full_name,
                {_initcap("trim(city)")} AS city, {_STREET} AS street,
                concat_ws(', ', {_STREET}, CAST(number AS VARCHAR)) AS address_line,
                upper(trim(zipcode)) AS zipcode FROM u""",
        ),
        "phone_clean": _with(_U, f"SELECT id, version, {_PHONE} AS phone FROM u"),
        "dedup_latest": _latest("events", "user_id", "ts DESC NULLS LAST, event_id DESC"),
        "dim_category": _with(
            f"{_PRODUCTS}, {_DIM_PRODUCT}",
            f"SELECT category_key, category, {AUDIT} FROM dim_category",
        ),
        "dim_product": _with(
            f"{_PRODUCTS}, {_DIM_PRODUCT}", f"SELECT *, {AUDIT} FROM dim_product"
        ),
        "dim_city": _with(
            f"{_USERS}, {_DIM_USER}", f"SELECT city_key, city, zipcode, {AUDIT} FROM dim_city"
        ),
        "dim_user": _with(f"{_USERS}, {_DIM_USER}", f"SELECT *, {AUDIT} FROM dim_user"),
        "user_directory": _with(
            f"{_USERS}, {_DIM_USER}",
            f"""SELECT user_id AS id, full_name, first_name, last_name, email, username, phone,
                city, zipcode, latitude, longitude, TRUE AS is_active, {STAMP} AS updated_at
                FROM dim_user LEFT JOIN dim_city USING (city_key)""",
        ),
        "surrogate_key_int": f"""SELECT p_partkey,
            {_key(_hash_int("p_size"))} AS int_key,
            {_key(_hash_int("-p_size"))} AS negative_key,
            {_key(_hash_bigint("p_partkey"))} AS bigint_key,
            {part_pair} AS text_pair_key FROM part""",
        "global_rating_mean": _with(
            _RATINGS,
            """SELECT round(coalesce(avg(rating_rate), 0.0), 6) AS m_global,
               CAST(20 AS INTEGER) AS c_prior FROM ratings WHERE dt IS NOT NULL""",
        ),
        "fact_product_metrics_daily": _with(_FACT, "SELECT * FROM fact"),
        "latest_dt_per_product": _with(
            _RATINGS,
            f"""SELECT {_key(_hash_bigint("id"))} AS product_key, max(dt) AS dt
                FROM ratings WHERE dt IS NOT NULL GROUP BY 1""",
        ),
        "product_catalog": _with(_CATALOG, "SELECT * FROM catalog"),
        "product_catalog_top20": _with(
            _CATALOG, "SELECT * FROM catalog ORDER BY last_dt DESC, id LIMIT 20"
        ),
        "latest_fact_per_product": _with(
            _FACT,
            """SELECT product_id, rating_count_cum, rating_bayes_score, dt FROM fact
               QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY dt DESC) = 1""",
        ),
        "bronze_one_per_id": _with(
            _P,
            """SELECT id, version, title, price FROM p WHERE id IS NULL UNION ALL
               SELECT id, version, title, price FROM p WHERE id IS NOT NULL
               QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC) = 1""",
        ),
        "accepted_users": _with(
            _USERS, "SELECT id, email, username, zipcode FROM users WHERE NOT dq_invalid_flag"
        ),
        "dim_user_null_safe": _with(
            f"{_USERS}, {_DIM_USER}",
            f"""SELECT id AS user_id, city_key FROM users u LEFT JOIN dim_city c
                ON {_initcap("trim(u.city)")} IS NOT DISTINCT FROM c.city
                AND upper(trim(u.zipcode)) IS NOT DISTINCT FROM c.zipcode""",
        ),
        "contract_violations": _with(
            f"{_P}, {_U}, {_RATINGS}",
            f"""SELECT 'products.id not null' AS contract, count(*) AS violations FROM p WHERE id IS NULL
            UNION ALL SELECT 'products.category not null', count(*) FROM p WHERE category IS NULL
            UNION ALL SELECT 'products.rating_rate range', count(*) FROM p WHERE rate NOT BETWEEN 0 AND 5
            UNION ALL SELECT 'users.id not null', count(*) FROM u WHERE id IS NULL
            UNION ALL SELECT 'ratings.grain', count(*) FROM
              (SELECT 1 FROM ratings WHERE dt IS NOT NULL GROUP BY dt, id HAVING count(*) > 1)
            UNION ALL SELECT 'parts.size_key collisions', count(*) FROM
              (SELECT 1 FROM part GROUP BY p_size HAVING count(DISTINCT p_partkey) > 1)""",
        ),
        "value_change_per_user": """SELECT event_id, user_id, round(value - coalesce(
            CASE WHEN lag(event_id) OVER w IS NOT NULL THEN lag(value) OVER w ELSE 0 END, 0), 6) AS change
            FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
        "upsert_scd1": _with(
            f"""{_P}, flat AS (SELECT id, trim(title) AS title, round(price, 2) AS price, ingestion_ts,
                version FROM p WHERE id IS NOT NULL),
                best AS ({_latest("flat", "id", "ingestion_ts DESC NULLS LAST, version DESC")})""",
            "SELECT * FROM best",
        ),
        "schema_evolution_union": _with(
            _P,
            """SELECT id, version, title, price, NULL::VARCHAR AS image, NULL::VARCHAR AS description
               FROM p WHERE version = 1
               UNION ALL SELECT id, version, NULL, price, image, description FROM p WHERE version > 1""",
        ),
        "raw_chunk_assignment": """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS batch, o_orderkey,
            CAST(floor((row_number() OVER (PARTITION BY date_trunc('month', o_orderdate)
                 ORDER BY o_orderkey) - 1) / 50) + 1 AS BIGINT) AS seq FROM orders""",
        "raw_chunk_assignment_sparse": """SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS batch,
            o_orderkey * 1000000007 AS order_no,
            CAST(floor((row_number() OVER (PARTITION BY date_trunc('year', o_orderdate)
                 ORDER BY o_orderkey) - 1) / 50) + 1 AS BIGINT) AS seq FROM orders""",
        "bronze_products_typed": """SELECT p_partkey AS k,
            CASE WHEN p_partkey % 13 = 0 OR p_partkey % 11 = 0 THEN NULL
                 WHEN p_partkey % 7 = 0 THEN p_partkey ELSE p_partkey + 3000000000 END AS id,
            CASE WHEN part_ok THEN p_name END AS title, CASE WHEN part_ok THEN CAST(p_size AS DOUBLE) END AS price,
            CASE WHEN part_ok THEN p_type END AS category,
            CASE WHEN part_ok THEN p_size / CAST(8 AS DOUBLE) END AS rate, CASE WHEN part_ok THEN p_size END AS count
            FROM (SELECT *, p_partkey % 13 <> 0 AND (p_partkey % 11 = 0 OR p_partkey % 7 <> 0) AS part_ok FROM part)""",
        "bronze_users_typed": """SELECT c_custkey AS k,
            CASE WHEN c_custkey % 9 = 0 OR c_custkey % 10 <> 0 THEN c_custkey END AS id,
            CASE WHEN c_custkey % 9 = 0 THEN 'j@e.com' WHEN ok THEN lower(c_name) END AS email,
            CASE WHEN ok THEN c_nationkey END AS __v, CASE WHEN ok THEN c_mktsegment END AS firstname,
            CASE WHEN ok THEN c_nationkey END AS number, CASE WHEN ok THEN CAST(c_nationkey AS VARCHAR) END AS lat
            FROM (SELECT *, c_custkey % 9 <> 0 AND c_custkey % 10 <> 0 AS ok FROM customer)""",
        "payload_rows": """SELECT c_custkey // 100 AS page, kind, c_custkey AS id, c_name AS name
            FROM customer, (VALUES ('array'), ('object')) AS k(kind)""",
        "source_lineage": """SELECT 'part' AS source, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_unnamed FROM part
            UNION ALL SELECT 'customer', count(*), 0 FROM customer
            UNION ALL SELECT 'supplier', count(*), 0 FROM supplier""",
        "broken_lines": """SELECT p_partkey AS k,
            CASE WHEN p_partkey % 13 <> 0 AND p_partkey % 11 <> 0 THEN p_partkey END AS id,
            CASE WHEN p_partkey % 13 <> 0 AND p_partkey % 11 = 0 THEN p_name END AS title,
            CASE WHEN p_partkey % 13 = 0 THEN 'not_json' ELSE 'field_mistyped' END AS reason,
            CASE WHEN p_partkey % 13 = 0 THEN substr(concat('{"id":', p_partkey + 3000000000, ',"title":"', p_name), 1, 20)
                 WHEN p_partkey % 11 = 0 THEN concat('{"id":"x","other":', p_partkey + 3000000000, ',"title":"', p_name,
                      '","price":', p_size, ',"category":"', p_type, '","rating":{"rate":', p_size / CAST(8 AS DOUBLE),
                      ',"count":', p_size, '}}')
                 ELSE concat('{"id":', p_partkey, ',"rating":"none"}') END AS broken_line
            FROM part WHERE p_partkey % 13 = 0 OR p_partkey % 11 = 0 OR p_partkey % 7 = 0""",
        "key_registry_first": _with(
            _USERS,
            """SELECT city, zipcode, row_number() OVER (ORDER BY city NULLS FIRST, zipcode NULLS FIRST) AS key
               FROM (SELECT DISTINCT city, zipcode FROM u_flat WHERE city IS NOT NULL OR zipcode IS NOT NULL)""",
        ),
        "key_registry_next": """WITH f AS (SELECT p_name, min(p_partkey % 3) AS run FROM part GROUP BY 1),
            r AS (SELECT run, count(*) AS n FROM f GROUP BY 1),
            s AS (SELECT run, n, sum(n) OVER (ORDER BY run) AS last FROM r)
            SELECT run::INTEGER AS run, n, (last - n + 1)::BIGINT AS first, last::BIGINT AS last FROM s
            UNION ALL SELECT -1, sum(n)::BIGINT, 1, sum(n)::BIGINT FROM r""",
        "ndjson_lines": _with(
            _P,
            """SELECT version, id, title, price, description, category, image, rate AS rating_rate,
               cnt AS rating_count, 'id,title,price,description,category,image,rating' AS keys FROM p""",
        ),
        "json_line_validation": """SELECT file_origin, count(*) AS n_lines,
            count(*) FILTER (WHERE NOT json_valid(line)) AS n_bad FROM (
              SELECT event_type || '-' || CAST(event_id % 2 AS VARCHAR) AS file_origin,
                CASE WHEN event_id % 29 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END AS line
              FROM events) GROUP BY file_origin""",
        "flat_relational_products": _with(
            _P,
            f"""SELECT id, title, price, description, category, image, rate AS rating_rate,
                cnt AS rating_count, coalesce(ingestion_ts, {STAMP}) AS date_ingest FROM p""",
        ),
    }
    # Two daily runs: first versions, then second ones where there are any.
    second = _PRODUCTS.replace("FROM p\n", "FROM p WHERE version <= 2\n")
    found["landed_products"] = _with(
        _P,
        """SELECT id, version, title, price, description, category, image, rate AS rating_rate, cnt AS rating_count,
           TRUE AS whole, TRUE AS named FROM p""",
    )
    found["lake_catalog"] = _with(
        second,
        """SELECT id, title, category, price AS current_price, rating_rate AS current_rating_rate,
           rating_count AS current_rating_count,
           round((20 * (SELECT coalesce(avg(rating_rate), 0.0) FROM products) + rating_rate * 2 * coalesce(rating_count, 0))
                 / (20 + 2 * coalesce(rating_count, 0)), 6) AS rating_bayes_score,
           image, DATE '2024-01-02' AS last_dt, CAST(coalesce(rating_count, 0) AS BIGINT) AS first_count,
           CAST(2 * coalesce(rating_count, 0) AS BIGINT) AS last_count, DATE '2024-01-01' AS first_dt
           FROM products WHERE category IS NOT NULL""",
    )
    days = f"""SELECT '2024-01-01' AS day, * FROM ({_latest("(SELECT * FROM p_issues WHERE id IS NOT NULL AND version = 1)", "id", "version")})
        UNION ALL SELECT '2024-01-02' AS day, * FROM ({_latest("(SELECT * FROM p_issues WHERE id IS NOT NULL)", "id", "version DESC")})"""
    versioned = second.replace("ingestion_ts, TIMESTAMP", "ingestion_ts, version, TIMESTAMP", 1)
    metrics = {
        "rows": "true",
        "invalid": "len(issues) > 0",
        "issue:line_not_json": "false",
        "issue:field_mistyped": "false",
        **{f"issue:{t}": f"list_contains(issues, '{t}')" for t in ("id_null", "title_empty", "price_invalid", "category_unmapped")},
        **{f"null:{c}": f"{c} IS NULL" for c in ("price", "image", "rating_rate")},
    }
    counted = " UNION ALL ".join(
        f"SELECT day, '{name}' AS metric, count(*) FILTER ({test}) AS n FROM days GROUP BY day" for name, test in metrics.items()
    )
    found["lake_measures"] = _with(
        f"{versioned}, days AS ({days})",
        f"{counted} UNION ALL SELECT '2024-01-01', 'batches', 1 UNION ALL SELECT '2024-01-02', 'batches', 2",
    )
    # A dimension from elsewhere gives the same rows as keys computed in place.
    for name in ("dim_product", "dim_user", "user_directory", "product_catalog"):
        found[f"{name}_by_join"] = found[name]
    return found

"""The same answers in plain SQL, for DuckDB over the given tables.

Each statement stands alone: it starts from the common table expressions below,
which read the order tables as reviews, and states the result in SQL terms
(windows, DISTINCT, IS NOT DISTINCT FROM) rather than in terms of the Spark plans.
"""

from __future__ import annotations

from starloom.schemas import DIM_DATE, NF_PRODUCT, NF_REVIEW, PROFILE_ATTRIBUTES, RAW_PRODUCT_COLUMNS
from starloom.sources.tpch_reviews import BAD_VALUES

_BASE = """
WITH lines AS (
  SELECT l.*, o_custkey, o_orderpriority, o_orderstatus, c_mktsegment,
         CAST(l_shipdate AS DATE) AS day, CAST(round(l_discount * 100) AS INTEGER) AS votes
  FROM lineitem l
  LEFT JOIN orders ON o_orderkey = l_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
), fact AS (
  SELECT ((l_orderkey * 8 + l_linenumber) * 100000 + l_suppkey) * 10000
           + date_diff('day', DATE '1990-01-01', day) AS source_row_id,
         CAST(l_partkey AS VARCHAR) AS product_id, l_partkey AS product_key,
         CAST(o_custkey AS VARCHAR) AS author_id, o_custkey AS customer_key,
         day AS submission_date, CAST(strftime(day, '%Y%m%d') AS BIGINT) AS date_key,
         CAST(l_quantity AS BIGINT) % 5 + 1 AS rating,
         CASE l_returnflag WHEN 'N' THEN true WHEN 'R' THEN false END AS is_recommended,
         CAST(votes AS BIGINT) AS total_feedback_count,
         CAST(votes // 2 AS BIGINT) AS total_pos_feedback_count,
         CAST(votes - votes // 2 AS BIGINT) AS total_neg_feedback_count,
         (votes // 2)::DOUBLE / nullif(votes, 0) AS helpfulness,
         CASE WHEN l_suppkey % 50 <> 0 THEN CAST(floor(l_extendedprice / 80) AS BIGINT) END AS review_length,
         coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), 'Unknown') AS skin_tone,
         coalesce(o_orderstatus, 'Unknown') AS skin_type,
         coalesce(c_mktsegment, 'Unknown') AS eye_color,
         coalesce(l_linestatus, 'Unknown') AS hair_color,
         *
  FROM lines
), product AS (
  SELECT p_partkey AS product_key, CAST(p_partkey AS VARCHAR) AS product_id,
         p_name || ' ' || p_partkey AS product_name,
         CAST(split_part(p_brand, '#', 2) AS BIGINT) AS brand_key, p_brand AS brand_name,
         p_type AS primary_category, 'S' || p_size % 8 AS secondary_category,
         CASE WHEN p_size % 5 <> 0 THEN p_name END AS tertiary_category,
         CAST((p_retailprice - 900) * 2 + 3 AS DECIMAL(10,2)) AS price_usd,
         p_size || ' oz' AS size, CAST(p_size * 1000 + p_partkey % 97 AS BIGINT) AS loves_count,
         p_size % 2 = 0 AS limited_edition, p_size % 3 = 0 AS new, p_size % 4 = 0 AS online_only,
         p_size % 7 = 0 AS out_of_stock, p_size % 5 = 1 AS retailer_exclusive, p_size
  FROM part
), band AS (
  SELECT *, CASE WHEN price_usd < 0 THEN NULL WHEN price_usd < 15 THEN 'Under $15'
                 WHEN price_usd < 30 THEN '$15-30' WHEN price_usd < 50 THEN '$30-50'
                 WHEN price_usd < 100 THEN '$50-100' WHEN price_usd >= 100 THEN '$100+' END AS price_band
  FROM product
), review AS (
  SELECT * FROM fact JOIN band USING (product_key)
), raw AS (
  SELECT source_row_id, 'reviews_' || l_suppkey % 5 || '.csv' AS source_file, author_id, rating,
         is_recommended, helpfulness, total_feedback_count, total_neg_feedback_count,
         total_pos_feedback_count, submission_date,
         CASE WHEN l_suppkey % 50 <> 0 THEN
           o_orderpriority || ', "' || CAST(l_quantity AS BIGINT) || '"' || chr(10) || 'ship ' || day
         END AS review_text,
         CASE WHEN l_linenumber <> 3 THEN l_returnflag || ' ' || l_linestatus END AS review_title,
         o_orderpriority, o_orderstatus AS skin_type, c_mktsegment, l_linestatus AS hair_color,
         product_id, 'part ' || product_id AS product_name, 'any' AS brand_name, l_tax
  FROM fact
), files AS (
  SELECT * FROM raw
  UNION ALL
  SELECT * REPLACE (1000000000000000000 + source_row_id AS source_row_id,
                    'reviews_9.csv' AS source_file)
  FROM raw WHERE source_row_id % 10 = 0
), kept AS (
  SELECT * FROM files
  QUALIFY row_number() OVER (PARTITION BY author_id, product_id, submission_date
                             ORDER BY source_file, source_row_id) = 1
), known AS (
  SELECT f.*, p.p_size <= 48 AS has_product, c.c_acctbal >= 0 AS has_customer,
         (skin_type <> 'P' OR hair_color <> 'F') AS has_profile,
         submission_date <= DATE '2001-06-30' AS has_date
  FROM fact f LEFT JOIN part p ON p.p_partkey = f.product_key
  LEFT JOIN customer c ON c.c_custkey = f.customer_key
), outcome AS (
  SELECT *, CASE WHEN NOT coalesce(has_product, false) THEN 'unresolved_product'
                 WHEN NOT coalesce(has_customer, false) THEN 'unresolved_customer'
                 WHEN NOT has_profile THEN 'unresolved_reviewer_profile'
                 WHEN NOT has_date THEN 'out_of_range_date' END AS reason
  FROM known
)"""

_N = "count(*) AS review_count"
_PRODUCTS = "count(DISTINCT product_key) AS product_count"
_RATING = "round(sum(rating)::DOUBLE / count(*), 4) AS avg_rating"
_YES = ("round(100 * sum(is_recommended::INTEGER)::DOUBLE / nullif(count(is_recommended), 0), 2) "
        "AS recommend_pct")
_PRICE = "round(sum(price_usd)::DOUBLE / nullif(count(price_usd), 0), 2) AS avg_price_usd"
_SPREAD = "round(stddev_pop(rating), 4) AS rating_stddev"
_WEIGHTED = ("round(sum(CAST(avg_rating AS DECIMAL(10,4)) * review_count)::DOUBLE / sum(review_count), 4) "
             "AS avg_rating")

_CATEGORIES = "('S1', 'S4', 'S7')"
_BRANDS = "('Brand#3', 'Brand#11', 'Brand#20')"

_sql: dict[str, str] = {}


def _add(name: str, body: str, **extra: str) -> None:
    more = "".join(f", {n} AS ({text})" for n, text in extra.items())
    _sql[name] = f"{_BASE}{more}\n{body}"


def all_sql() -> dict[str, str]:
    return dict(_sql)


# --- views -----------------------------------------------------------------------------------

_by_brand = f"""
  SELECT brand_key, brand_name, {_N}, {_PRODUCTS}, {_RATING}, {_YES}, {_PRICE},
         count(*) FILTER (WHERE rating = 5) AS five_star,
         count(*) FILTER (WHERE rating = 1) AS one_star
  FROM review GROUP BY brand_key, brand_name"""
_by_category = f"""
  SELECT primary_category, secondary_category, tertiary_category,
         {_N}, {_PRODUCTS}, {_RATING}, {_YES}, {_PRICE}
  FROM review GROUP BY ALL"""
_by_brand_category = f"""
  SELECT brand_key, brand_name, secondary_category, {_N}, {_PRODUCTS}, {_RATING}, {_YES}, {_PRICE}
  FROM review GROUP BY ALL"""
_by_band = f"""
  SELECT price_band, CASE price_band WHEN 'Under $15' THEN 1 WHEN '$15-30' THEN 2 WHEN '$30-50' THEN 3
                                     WHEN '$50-100' THEN 4 WHEN '$100+' THEN 5 END::BIGINT AS band_order,
         {_N}, {_PRODUCTS}, {_RATING}, {_YES}, {_PRICE}, {_SPREAD}
  FROM review GROUP BY ALL"""
_by_type = f"""
  SELECT skin_type, primary_category, secondary_category, {_N}, {_PRODUCTS}, {_RATING}, {_YES}
  FROM review WHERE primary_category = 'PROMO' GROUP BY ALL"""
_by_tone = f"""
  SELECT skin_tone, primary_category, secondary_category, {_N}, {_PRODUCTS},
         count(DISTINCT customer_key) AS reviewer_count, {_RATING}, {_YES}, {_SPREAD}
  FROM review GROUP BY ALL"""
_kpi = f"""
  SELECT count(*) AS total_reviews, count(DISTINCT customer_key) AS total_reviewers,
         count(DISTINCT product_key) AS products_reviewed,
         (SELECT count(*) FROM part) AS products_in_catalogue,
         (SELECT count(DISTINCT p_brand) FROM part) AS total_brands,
         {_RATING}, {_YES},
         round(avg(helpfulness) FILTER (WHERE total_feedback_count > 0), 4) AS avg_helpfulness,
         count(*) FILTER (WHERE total_feedback_count > 0) AS reviews_with_feedback,
         min(submission_date) AS earliest_review, max(submission_date) AS latest_review
  FROM fact"""
_hype = f"""
  SELECT product_id, product_name, brand_name, primary_category, secondary_category,
         price_usd::DOUBLE AS price_usd, price_band, loves_count, review_count, avg_rating, recommend_pct,
         round(percent_rank() OVER (ORDER BY loves_count), 4) AS loves_percentile,
         round(percent_rank() OVER (ORDER BY avg_rating), 4) AS rating_percentile,
         round(percent_rank() OVER (ORDER BY loves_count)
               - percent_rank() OVER (ORDER BY avg_rating), 4) AS hype_gap
  FROM (SELECT band.product_id, product_name, brand_name, primary_category, secondary_category, price_usd,
               price_band, loves_count, {_N}, {_RATING}, {_YES}
        FROM fact JOIN band USING (product_key) GROUP BY ALL HAVING count(*) >= 20)"""
_monthly = """
  SELECT year(submission_date) AS year, month(submission_date) AS month,
         CAST(date_trunc('month', submission_date) AS DATE) AS month_start,
         count(*) AS review_count, count(DISTINCT customer_key) AS reviewer_count,
         count(DISTINCT product_key) AS product_count, avg(rating) AS mean,
         100 * avg(is_recommended::INTEGER) AS yes
  FROM fact GROUP BY ALL"""
_volume = f"""
  SELECT year, month, month_start, review_count, reviewer_count, product_count,
         round(mean, 4) AS avg_rating, round(yes, 2) AS recommend_pct,
         round(avg(mean) OVER (ORDER BY month_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4)
           AS rolling_3m_avg_rating,
         round(avg(mean) OVER (ORDER BY month_start
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4)
           AS cumulative_avg_rating,
         CAST(sum(review_count) OVER (ORDER BY month_start
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_reviews,
         lag(review_count) OVER (ORDER BY month_start) AS prev_month_reviews,
         round((review_count - lag(review_count) OVER (ORDER BY month_start)) * 100::DOUBLE
               / nullif(lag(review_count) OVER (ORDER BY month_start), 0), 2) AS mom_growth_pct,
         month_start = (SELECT CAST(date_trunc('month', max(submission_date)) AS DATE) FROM fact)
           AS is_partial_month
  FROM ({_monthly})"""
_bucket = """CASE WHEN review_length IS NULL THEN 'Unknown' WHEN review_length < 100 THEN 'Very short (<100)'
              WHEN review_length < 250 THEN 'Short (100-249)' WHEN review_length < 500 THEN 'Medium (250-499)'
              WHEN review_length < 1000 THEN 'Long (500-999)' ELSE 'Very long (1000+)' END"""
_place = """CASE WHEN review_length IS NULL THEN 0 WHEN review_length < 100 THEN 1
             WHEN review_length < 250 THEN 2 WHEN review_length < 500 THEN 3
             WHEN review_length < 1000 THEN 4 ELSE 5 END::BIGINT"""
_by_length = f"""
  SELECT {_bucket} AS length_bucket, {_place} AS bucket_order, {_N},
         round(avg(review_length), 1) AS avg_review_length, {_RATING}, {_YES}, {_SPREAD},
         round(100::DOUBLE * count(*) FILTER (WHERE rating = 1) / count(*), 2) AS pct_1_star,
         round(100::DOUBLE * count(*) FILTER (WHERE rating = 5) / count(*), 2) AS pct_5_star,
         round(100::DOUBLE * count(*) FILTER (WHERE rating IN (1, 5)) / count(*), 2) AS pct_extreme
  FROM fact GROUP BY 1, 2"""
_dates_as_text = "month_start::VARCHAR AS month_start"

_add("rating_by_brand", _by_brand)
_add("rating_by_category", _by_category)
_add("review_trend_monthly", f"""
  SELECT year(submission_date) AS year, month(submission_date) AS month,
         monthname(submission_date) AS month_name,
         CAST(CAST(date_trunc('month', submission_date) AS DATE) AS VARCHAR) AS month_start,
         {_N}, {_RATING}, {_YES}, count(DISTINCT customer_key) AS reviewer_count, {_PRODUCTS},
         round(avg(review_length), 1) AS avg_review_length
  FROM fact GROUP BY ALL""")
_add("rating_by_price_band", _by_band)
_add("rating_by_profile_type", _by_type)
_add("kpi_summary", """SELECT * REPLACE (earliest_review::VARCHAR AS earliest_review,
                       latest_review::VARCHAR AS latest_review) FROM kpi""", kpi=_kpi)
_add("hype_vs_reality", _hype)
_add("volume_by_month", f"SELECT * REPLACE ({_dates_as_text}) FROM volume", volume=_volume)
_add("rating_by_profile_tone", _by_tone)
_add("rating_by_length", _by_length)
_add("rating_by_brand_category", _by_brand_category)
_add("views_by_name", "SELECT brand_name, review_count, avg_rating FROM brands WHERE review_count >= 100",
     brands=_by_brand)

# --- parameterised reports -------------------------------------------------------------------

_add("brand_ranking", f"""SELECT brand_name, review_count, avg_rating FROM brands
     WHERE review_count >= 100 AND brand_name IN {_BRANDS}""", brands=_by_brand)
_add("brand_ranking_scoped", f"""
  SELECT brand_name, CAST(sum(review_count) AS BIGINT) AS review_count, {_WEIGHTED}
  FROM slices WHERE secondary_category IN {_CATEGORIES}
  GROUP BY brand_name HAVING sum(review_count) >= 100""", slices=_by_brand_category)
_add("brand_extremes", """
  SELECT brand_name, review_count, avg_rating,
         round(avg_rating - (SELECT avg_rating FROM kpi), 4) AS delta,
         (SELECT round(max(avg_rating) - min(avg_rating), 4) FROM brands WHERE review_count >= 100) AS spread
  FROM (SELECT *, row_number() OVER (ORDER BY avg_rating DESC, brand_name) AS best,
               row_number() OVER (ORDER BY avg_rating, brand_name DESC) AS worst
        FROM brands WHERE review_count >= 100)
  WHERE best <= 10 OR worst <= 10""", brands=_by_brand, kpi=_kpi)
for _name, _order in (("top_brands", "avg_rating DESC"), ("bottom_brands", "avg_rating")):
    _add(_name, f"""SELECT brand_name, review_count, avg_rating, recommend_pct, avg_price_usd
         FROM brands WHERE review_count >= 100 ORDER BY {_order}, brand_name LIMIT 5""", brands=_by_brand)
_add("category_ranking", f"""
  SELECT secondary_category, CAST(sum(review_count) AS BIGINT) AS reviews, {_WEIGHTED}
  FROM triples WHERE secondary_category IN {_CATEGORIES} GROUP BY 1""", triples=_by_category)
_add("category_totals", f"""
  SELECT secondary_category, CAST(sum(review_count) AS BIGINT) AS reviews, {_WEIGHTED}
  FROM triples GROUP BY 1""", triples=_by_category)
_add("price_band_series", """SELECT price_band, band_order, review_count, product_count, avg_rating,
     recommend_pct, rating_stddev FROM bands""", bands=_by_band)
_add("band_peaks", """
  SELECT peak.price_band AS peak_band, peak.avg_rating AS peak_rating,
         tight.price_band AS tightest_band, tight.rating_stddev AS tightest_stddev,
         last.price_band AS top_band, last.rating_stddev AS top_band_stddev,
         peak.price_band = tight.price_band AS same_band
  FROM (SELECT * FROM bands ORDER BY avg_rating DESC, band_order LIMIT 1) peak,
       (SELECT * FROM bands ORDER BY rating_stddev, band_order LIMIT 1) tight,
       (SELECT * FROM bands ORDER BY band_order DESC LIMIT 1) last""", bands=_by_band)
_hype_columns = """product_id, product_name, brand_name, secondary_category, price_usd, loves_count,
  review_count, avg_rating, hype_gap"""
_add("hype_top_bottom", f"""
  (SELECT {_hype_columns}, 'overhyped' AS side FROM hype WHERE secondary_category IN {_CATEGORIES}
   ORDER BY hype_gap DESC, product_id LIMIT 10)
  UNION ALL
  (SELECT {_hype_columns}, 'sleeper hit' FROM hype WHERE secondary_category IN {_CATEGORIES}
   ORDER BY hype_gap, product_id LIMIT 10)""", hype=_hype)
_add("hype_labels", """
  SELECT product_id, loves_count, avg_rating,
         brand_name || ' · ' || CASE WHEN length(product_name) > 26
           THEN rtrim(product_name[1:25]) || '…' ELSE product_name END AS label
  FROM hype ORDER BY hype_gap DESC, product_id LIMIT 3""", hype=_hype)
_add("product_explorer", f"""
  SELECT brand_name, product_name, secondary_category, price_usd, review_count, avg_rating,
         recommend_pct, loves_count, hype_gap
  FROM hype WHERE secondary_category IN {_CATEGORIES} AND brand_name IN {_BRANDS}
    AND product_name ILIKE '%GEAR%'""", hype=_hype)
_add("profile_ranking", f"""
  SELECT skin_type, CAST(sum(review_count) AS BIGINT) AS reviews, {_WEIGHTED}
  FROM types WHERE secondary_category IN {_CATEGORIES} GROUP BY 1 HAVING sum(review_count) >= 100""",
     types=_by_type)
_add("tone_totals", f"""SELECT skin_tone, CAST(sum(review_count) AS BIGINT) AS reviews, {_WEIGHTED}
     FROM tones GROUP BY 1""", tones=_by_tone)
_shares = """SELECT length_bucket, bucket_order, review_count, avg_rating, rating_stddev, pct_1_star,
  pct_5_star FROM lengths WHERE length_bucket <> 'Unknown'"""
_add("length_shares", _shares, lengths=_by_length)
_add("length_contrast", """
  SELECT a.length_bucket AS shortest_length_bucket, a.pct_1_star AS shortest_pct_1_star,
         a.pct_5_star AS shortest_pct_5_star, a.rating_stddev AS shortest_rating_stddev,
         b.length_bucket AS longest_length_bucket, b.pct_1_star AS longest_pct_1_star,
         b.pct_5_star AS longest_pct_5_star, b.rating_stddev AS longest_rating_stddev,
         (SELECT round(max(avg_rating) - min(avg_rating), 4) FROM shares) AS rating_spread
  FROM (SELECT * FROM shares ORDER BY bucket_order LIMIT 1) a,
       (SELECT * FROM shares ORDER BY bucket_order DESC LIMIT 1) b""",
     lengths=_by_length, shares=_shares)
_add("trend_series", f"""SELECT {_dates_as_text}, review_count, avg_rating, rolling_3m_avg_rating,
     is_partial_month FROM volume""", volume=_volume)
_add("trend_peaks", """
  SELECT a.month_start::VARCHAR AS peak_month, a.review_count AS peak_reviews,
         b.month_start::VARCHAR AS lowest_month, b.avg_rating AS lowest_rating
  FROM (SELECT * FROM volume ORDER BY review_count DESC, month_start LIMIT 1) a,
       (SELECT * FROM volume ORDER BY avg_rating, month_start LIMIT 1) b""", volume=_volume)
_add("yearly_trend", f"""SELECT year, CAST(sum(review_count) AS BIGINT) AS reviews, {_WEIGHTED}
     FROM volume GROUP BY year""", volume=_volume)
_add("latest_months", f"""SELECT {_dates_as_text}, review_count, is_partial_month
     FROM volume ORDER BY volume.month_start DESC LIMIT 3""", volume=_volume)
_add("filter_options", "SELECT DISTINCT secondary_category FROM review")
_add("brand_options", f"SELECT DISTINCT brand_name FROM review WHERE secondary_category IN {_CATEGORIES}")
_add("kpi_with_delta", """SELECT * REPLACE (earliest_review::VARCHAR AS earliest_review,
     latest_review::VARCHAR AS latest_review), total_reviews - 50000 AS reviews_added FROM kpi""", kpi=_kpi)

# --- validation ------------------------------------------------------------------------------

_total_of = {
    "fact_reviews": "SELECT count(*) FROM fact",
    "vw_kpi_summary": f"SELECT total_reviews FROM ({_kpi})",
    "vw_rating_by_brand": f"SELECT sum(review_count) FROM ({_by_brand})",
    "vw_rating_by_category": f"SELECT sum(review_count) FROM ({_by_category})",
    "vw_rating_by_brand_category": f"SELECT sum(review_count) FROM ({_by_brand_category})",
    "vw_rating_by_price_band": f"SELECT sum(review_count) FROM ({_by_band})",
    "vw_review_trend_monthly": f"SELECT sum(review_count) FROM ({_monthly})",
    "vw_review_volume_by_month": f"SELECT sum(review_count) FROM ({_volume})",
    "vw_rating_by_skin_tone": f"SELECT sum(review_count) FROM ({_by_tone})",
    "vw_rating_by_review_length": f"SELECT sum(review_count) FROM ({_by_length})",
}
_totals = " UNION ALL ".join(
    f"SELECT '{name}' AS source, CAST(({text}) AS BIGINT) AS reviews" for name, text in _total_of.items())
_add("view_totals", """
  SELECT source, reviews, reviews - (SELECT count(*) FROM fact) AS diff_from_fact,
         CASE WHEN reviews = (SELECT count(*) FROM fact) THEN 'OK' ELSE 'MISMATCH' END AS status
  FROM totals""", totals=_totals)
_add("views_matching", """SELECT count(*) FILTER (WHERE reviews = (SELECT count(*) FROM fact)) AS matching,
     count(*) AS views FROM totals WHERE source <> 'fact_reviews'""", totals=_totals)
_add("subset_totals", f"""
  SELECT 'vw_rating_by_skin_type' AS view_name, CAST(sum(review_count) AS BIGINT) AS reviews,
         (SELECT count(*) FROM fact) AS fact_total FROM ({_by_type})
  UNION ALL
  SELECT 'vw_hype_vs_reality', CAST(sum(review_count) AS BIGINT), (SELECT count(*) FROM fact)
  FROM ({_hype})""")
_add("fact_range", """SELECT count(*) AS fact_rows, max(submission_date)::VARCHAR AS watermark,
     min(submission_date)::VARCHAR AS earliest FROM fact""")
_add("duplicate_keys", """
  SELECT count(*) FILTER (WHERE n > 1) AS key_groups, CAST(sum(n - 1) AS BIGINT) AS surplus_rows
  FROM (SELECT count(*) AS n FROM fact GROUP BY source_row_id, product_id)""")
_days = """(SELECT date_diff('day', min(submission_date), max(submission_date)) + 61 FROM fact)"""
_add("dimension_counts", f"""
  SELECT (SELECT count(DISTINCT p_brand) FROM part) AS brands, (SELECT count(*) FROM part) AS products,
         (SELECT count(*) FROM customer) AS customers,
         (SELECT count(DISTINCT (skin_tone, skin_type, eye_color, hair_color)) FROM fact)
           AS reviewer_profiles, {_days} AS dates""")
_add("orphans_by_reason", """
  SELECT 'unresolved_product' AS reason,
         count(*) FILTER (WHERE NOT coalesce(has_product, false)) AS rows FROM known
  UNION ALL SELECT 'unresolved_customer', count(*) FILTER (WHERE has_customer IS NULL) FROM known
  UNION ALL SELECT 'unresolved_reviewer_profile', count(*) FILTER (WHERE NOT has_profile) FROM known
  UNION ALL SELECT 'out_of_range_date', count(*) FILTER (WHERE NOT has_date) FROM known""")
_add("orphan_total", """SELECT count(*) AS orphan_rows FROM known
     WHERE NOT coalesce(has_product, false) OR has_customer IS NULL OR NOT has_profile OR NOT has_date""")

_layer_rows = {
    "raw.product_info": "(SELECT count(*) FROM part)",
    "raw.reviews": "(SELECT count(*) FROM kept)",
    "nf.brand": "(SELECT count(DISTINCT p_brand) FROM part)",
    "nf.category": """(SELECT count(*) FROM (SELECT DISTINCT primary_category, secondary_category,
                       tertiary_category FROM product))""",
    "nf.product": "(SELECT count(*) FROM part)",
    "nf.author": "(SELECT count(DISTINCT author_id) FROM kept)",
    "nf.skin_tone": """(SELECT count(DISTINCT nullif(o_orderpriority, '4-NOT SPECIFIED')) FROM kept)""",
    "nf.skin_type": "(SELECT count(DISTINCT skin_type) FROM kept)",
    "nf.eye_color": "(SELECT count(DISTINCT c_mktsegment) FROM kept)",
    "nf.hair_color": "(SELECT count(DISTINCT hair_color) FROM kept)",
    "nf.review": "(SELECT count(*) FROM kept)",
    "staging.product": "(SELECT count(*) FROM part)",
    "staging.review": "(SELECT count(*) FROM kept)",
}
_add("layer_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, {text} AS rows, "
    f"CAST({25 if n == 'nf.brand' else 'NULL'} AS BIGINT) AS expected" for n, text in _layer_rows.items()))
_add("layer_gaps", """
  SELECT 'review' AS entity, count(*) AS raw_rows, count(*) AS nf_rows,
         count(*) FILTER (WHERE source_row_id % 43 <> 0) AS staged_rows,
         count(*) FILTER (WHERE source_row_id % 43 = 0) AS gap FROM kept
  UNION ALL SELECT 'product', count(*), count(*), count(*) FILTER (WHERE p_size % 8 <> 3),
         count(*) FILTER (WHERE p_size % 8 = 3) FROM part""")
_add("row_accounting", """
  SELECT CAST(1 AS BIGINT) AS place, 'raw.reviews' AS stage, count(*) AS rows FROM kept
  UNION ALL SELECT 2, 'nf.review', count(*) FROM kept
  UNION ALL SELECT 3, 'staging.review', count(*) FROM kept
  UNION ALL SELECT 4, 'dw.fact_reviews', count(*) FROM kept WHERE submission_date < DATE '2001-01-01'""")
_add("integrity_checks", """
  SELECT 'reviews without product' AS check_name, (SELECT count(*) FROM twice
    WHERE product_id NOT IN (SELECT product_id FROM product WHERE p_size <= 48)) AS bad
  UNION ALL SELECT 'reviews without author', (SELECT count(*) FROM twice WHERE author_id::BIGINT % 7 = 0)
  UNION ALL SELECT 'products without brand', (SELECT count(*) FROM product WHERE p_size <= 48 AND brand_key = 25)
  UNION ALL SELECT 'products without category', (SELECT count(*) FROM product WHERE p_size <= 48 AND p_size % 8 = 3)
  UNION ALL SELECT 'staged reviews without attribute', (SELECT count(*) FROM kept WHERE source_row_id % 37 = 0)
  UNION ALL SELECT 'repeated load keys', (SELECT count(*) FROM kept WHERE source_row_id % 41 = 0)""",
     twice="SELECT * FROM kept UNION ALL SELECT * FROM kept WHERE source_row_id % 41 = 0")
_add("cutoff_split", """
  SELECT count(*) FILTER (WHERE submission_date < DATE '2001-01-01') AS full_load_rows,
         count(*) FILTER (WHERE submission_date >= DATE '2001-01-01') AS incremental_rows,
         count(*) AS total_rows, min(submission_date)::VARCHAR AS earliest,
         max(submission_date)::VARCHAR AS latest FROM fact""")
_loaded = """
  SELECT 'full' AS loaded, true AS present, * FROM fact
  UNION ALL SELECT 'historical', submission_date < DATE '2001-01-01', * FROM fact
  UNION ALL SELECT 'short', rating < 5, * FROM fact"""
_add("backlog_status", """
  SELECT loaded, staged_rows, fact_rows, watermark::VARCHAR AS watermark, after_watermark,
         staged_rows - fact_rows AS gap,
         CASE WHEN staged_rows = fact_rows THEN 'complete'
              WHEN staged_rows - fact_rows = after_watermark THEN 'held back'
              ELSE 'unaccounted' END AS status,
         CASE WHEN staged_rows - fact_rows NOT IN (0, after_watermark)
              THEN staged_rows - fact_rows - after_watermark ELSE 0 END AS unaccounted_rows
  FROM (SELECT loaded, count(*) AS staged_rows, count(*) FILTER (WHERE present) AS fact_rows,
               any_value(latest) AS watermark, count(*) FILTER (WHERE submission_date > latest) AS after_watermark
        FROM (SELECT *, max(submission_date) FILTER (WHERE present) OVER (PARTITION BY loaded) AS latest
              FROM loads) GROUP BY loaded)""", loads=_loaded)

# --- cleaning --------------------------------------------------------------------------------

_clean_review = """
  SELECT source_row_id, author_id, rating, is_recommended, round(helpfulness, 6) AS helpfulness,
         total_feedback_count, total_neg_feedback_count, total_pos_feedback_count,
         submission_date::VARCHAR AS submission_time, review_text, review_title,
         nullif(o_orderpriority, '4-NOT SPECIFIED') AS skin_tone,
         CASE c_mktsegment WHEN 'FURNITURE' THEN 'gray' ELSE c_mktsegment END AS eye_color,
         skin_type, hair_color, product_id, product_name, brand_name,
         CAST(l_tax AS DECIMAL(10,2))::DOUBLE AS price_usd, source_file,
         CAST(length(review_text) AS BIGINT) AS review_length"""
_add("cleaned_reviews", f"{_clean_review} FROM kept")
_add("csv_reviews", f"{_clean_review} FROM files")
_add("csv_catalogue", """
  SELECT product_id, price_usd::VARCHAR AS price_usd,
         CASE WHEN product_key % 9 = 0 THEN (price_usd - 1)::VARCHAR END AS sale_price_usd FROM product
  UNION ALL
  SELECT product_id, price_usd::VARCHAR, CASE WHEN product_key % 9 = 0 THEN (price_usd - 1)::VARCHAR END
  FROM product WHERE product_key % 50 = 0""")
_clean_product = """
  SELECT product_id, p_name AS product_name, brand_key AS brand_id, brand_name, loves_count,
         CASE WHEN product_key % 11 <> 0 THEN 1 + p.p_size % 5 END::DOUBLE AS rating,
         product_key % 500 AS reviews, CASE WHEN p.p_size % 10 <> 0 THEN size END AS size,
         CASE WHEN product_key % 2 = 0 THEN 'Color' END AS variation_type,
         CASE WHEN product_key % 2 = 0 THEN split_part(p_name, ' ', 1) END AS variation_value,
         CAST(NULL AS VARCHAR) AS variation_desc, p_type AS ingredients, price_usd::DOUBLE AS price_usd,
         CAST(NULL AS DOUBLE) AS value_price_usd,
         CASE WHEN product_key % 9 = 0 THEN price_usd - 1 END::DOUBLE AS sale_price_usd,
         limited_edition, new, online_only, out_of_stock, retailer_exclusive,
         CASE WHEN p.p_size % 10 = 0 THEN 'not a list['
              WHEN p.p_size % 10 < 9 THEN '[''' || p_type || ''', "' || p_brand || '''s"]' END AS highlights,
         primary_category, secondary_category, tertiary_category,
         CAST(p.p_size % 4 AS BIGINT) AS child_count,
         CAST(NULL AS DOUBLE) AS child_max_price, CAST(NULL AS DOUBLE) AS child_min_price
  FROM product p JOIN part ON p_partkey = product_key"""
_add("cleaned_catalogue", _clean_product)
_add("review_cleaning_steps", """
  SELECT 'rows_in' AS step, (SELECT count(*) FROM files) AS rows
  UNION ALL SELECT 'trimmed_cells', (SELECT count(review_text)
    + count(*) FILTER (WHERE source_file = 'reviews_9.csv') FROM files)
  UNION ALL SELECT 'rows_out', (SELECT count(*) FROM kept)
  UNION ALL SELECT 'duplicates_dropped', (SELECT count(*) FROM files) - (SELECT count(*) FROM kept)
  UNION ALL SELECT 'eye_color_respelled', (SELECT count(*) FROM kept WHERE c_mktsegment = 'FURNITURE')
  UNION ALL SELECT 'skin_tone_placeholder',
    (SELECT count(*) FROM kept WHERE o_orderpriority = '4-NOT SPECIFIED')""")
_add("catalogue_cleaning_steps", """
  SELECT 'rows_in' AS step, count(*) + count(*) FILTER (WHERE p_partkey % 50 = 0) AS rows FROM part
  UNION ALL SELECT 'trimmed_cells',
    count(*) FILTER (WHERE p_partkey % 7 = 0) + count(*) FILTER (WHERE p_partkey % 50 = 0) FROM part
  UNION ALL SELECT 'rows_out', count(*) FROM part
  UNION ALL SELECT 'duplicates_dropped', count(*) FILTER (WHERE p_partkey % 50 = 0) FROM part""")
_add("dedup_first", """
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
         CAST(l_shipdate AS DATE)::VARCHAR AS l_shipdate, l_partkey, l_suppkey, l_quantity
  FROM lineitem QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) = 1""")

# --- normalisation and dimensions ------------------------------------------------------------

_add("category_nullsafe", """
  SELECT p.product_id, c.* FROM product p JOIN (
    SELECT DISTINCT primary_category, secondary_category, tertiary_category FROM product) c
  ON c.primary_category IS NOT DISTINCT FROM p.primary_category
  AND c.secondary_category IS NOT DISTINCT FROM p.secondary_category
  AND c.tertiary_category IS NOT DISTINCT FROM p.tertiary_category""")
_add("unknown_defaults", """
  SELECT source_row_id, product_id,
         coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), 'Unknown') AS skin_tone,
         coalesce(skin_type, 'Unknown') AS skin_type,
         coalesce(CASE c_mktsegment WHEN 'FURNITURE' THEN 'gray' ELSE c_mktsegment END, 'Unknown') AS eye_color,
         coalesce(hair_color, 'Unknown') AS hair_color
  FROM kept""")
_add("staged_catalogue", """
  SELECT product_id, product_name, brand_id, brand_name, primary_category, secondary_category,
         tertiary_category, price_usd, size, loves_count, limited_edition, new, online_only,
         out_of_stock, retailer_exclusive FROM cleaned""", cleaned=_clean_product)
_add("brand_dimension", "SELECT DISTINCT brand_key AS brand_id, brand_name FROM product")
_add("customer_dimension", "SELECT DISTINCT author_id AS customer_id FROM fact")
_add("junk_dimension", "SELECT DISTINCT skin_tone, skin_type, eye_color, hair_color FROM fact")
_add("product_dimension", """
  SELECT product_id, product_name, brand_key AS brand_id, primary_category, secondary_category,
         tertiary_category, price_usd::DOUBLE AS price_usd, price_band, size, loves_count,
         limited_edition, new, online_only, out_of_stock, retailer_exclusive
  FROM band WHERE brand_key <> 25""")
_add("calendar", """
  SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(d AS DATE)::VARCHAR AS full_date,
         year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name,
         week(d) AS week, day(d) AS day, isodow(d) AS day_of_week, dayname(d) AS day_name,
         isodow(d) IN (6, 7) AS is_weekend
  FROM (SELECT unnest(generate_series(min(submission_date) - INTERVAL 30 DAY,
                                      max(submission_date) + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS d FROM fact)""")
_add("surrogate_keys", """SELECT count(*) AS rows, count(*) AS numbers, CAST(1001 AS BIGINT) AS first,
     1000 + count(*) AS last FROM customer""")
_add("percent_rank", """SELECT product_id, loves_count,
     round(percent_rank() OVER (ORDER BY loves_count), 6) AS loves_percentile FROM product""")

# --- fact load -------------------------------------------------------------------------------

_add("fact_resolved", """
  SELECT source_row_id, date_key, rating, is_recommended, round(helpfulness, 6) AS helpfulness,
         total_feedback_count, total_pos_feedback_count, total_neg_feedback_count, review_length,
         product_id, author_id AS customer_id, skin_tone, skin_type, eye_color, hair_color,
         submission_date::VARCHAR AS full_date
  FROM outcome WHERE reason IS NULL""")
_reasons = ("unresolved_product", "unresolved_customer", "unresolved_reviewer_profile", "out_of_range_date")
_add("drops_by_reason", " UNION ALL ".join(
    f"SELECT '{r}' AS reason, count(*) FILTER (WHERE reason = '{r}') AS rows FROM outcome" for r in _reasons))
_before = "submission_date < DATE '2001-01-01'"
_mark = f"(SELECT max(submission_date) FROM fact WHERE {_before})"
_add("load_modes", " UNION ALL ".join(
    f"""SELECT '{mode}' AS mode, count(*) AS rows, min(submission_date)::VARCHAR AS earliest,
        max(submission_date)::VARCHAR AS latest FROM fact WHERE {rule}"""
    for mode, rule in (("full", "true"), ("historical", f"submission_date >= DATE '2000-01-01' AND {_before}"),
                       ("incremental", "submission_date > (SELECT max(submission_date) FROM fact "
                        f"WHERE submission_date >= DATE '2000-01-01' AND {_before})"))))
_add("incremental_batch", f"""
  SELECT source_row_id, product_id, author_id, submission_date::VARCHAR AS submission_date, rating,
         is_recommended, round(helpfulness, 6) AS helpfulness, total_feedback_count,
         total_pos_feedback_count, total_neg_feedback_count, review_length, skin_tone, skin_type,
         eye_color, hair_color
  FROM fact WHERE submission_date > {_mark}""")
_add("watermark", """SELECT max(submission_date)::VARCHAR AS latest, max(submission_date)::VARCHAR AS loaded,
     '2000-01-01' AS empty FROM fact""")
_add("insert_absent", """
  SELECT n AS stored, n AS numbers, n AS last_number, few AS first_offered, few AS first_inserted,
         CAST(0 AS BIGINT) AS first_already_present, n AS second_offered, n - few AS second_inserted,
         few AS second_already_present, n AS third_offered, CAST(0 AS BIGINT) AS third_inserted,
         n AS third_already_present
  FROM (SELECT count(*) AS n, count(*) FILTER (WHERE c_acctbal < 0) AS few FROM customer)""")
_add("absent_rows", f"""SELECT source_row_id, product_id, submission_date::VARCHAR AS submission_date
     FROM fact WHERE NOT ({_before})""")
_add("batch_hand_over", """
  SELECT n AS first, n AS again, n AS held, n AS removed, CAST(0 AS BIGINT) AS left,
         five AS other_staged, five AS other_read
  FROM (SELECT count(*) AS n, count(*) FILTER (WHERE rating = 5) AS five FROM fact)""")
_last_day = "DATE '2001-06-30'"
_run_facts = f"""
  SELECT f.*, p.p_size <= 48 AS known, source_row_id % 9 <> 0 AS prompt,
         submission_date >= DATE '2000-01-01' AND {_before} AS old, submission_date <= {_last_day} AS early
  FROM fact f JOIN part p ON p.p_partkey = f.product_key"""
_second = "(old OR submission_date > m1)"
_run_marks = {
    "mark_1": """SELECT max(submission_date) AS m1 FROM runs WHERE old AND prompt AND early AND known""",
    "mark_2": f"""SELECT m1, max(submission_date) FILTER (WHERE early AND prompt AND known AND {_second}) AS m2
                  FROM runs, mark_1 GROUP BY ALL""",
    "mark_3": f"""SELECT m1, m2, max(submission_date) FILTER (
                    WHERE early AND known AND ((prompt AND {_second}) OR submission_date > m2)) AS m3
                  FROM runs, mark_2 GROUP BY ALL""",
    "marks": """SELECT m1, m2, m3, max(submission_date) FILTER (WHERE early AND known) AS m4,
                       max(submission_date) FILTER (WHERE known) AS m5 FROM runs, mark_3 GROUP BY ALL"""}
# Which staged reviews each run extracts, passes over as late, and finds present.
_run_rules = (
    (1, "historical", None, "m1", "prompt AND early", "false", "old", "false", "false"),
    (2, "incremental", "m1", "m2", "prompt AND early", "prompt AND early", "submission_date > m1",
     "submission_date <= m1 AND NOT (old AND known)", "false"),
    (3, "incremental", "m2", "m3", "early", "prompt AND early", "submission_date > m2",
     f"submission_date <= m2 AND NOT (prompt AND known AND {_second})", "false"),
    (4, "full", None, "m4", "early", "early", "true", "false",
     f"(prompt AND {_second}) OR submission_date > m2"),
    (5, "incremental", "m4", "m5", "true", "early", "submission_date > m4",
     "submission_date <= m4 AND NOT (early AND known)", "false"),
)


def _run_sql(run, mode, mark, after, staged, seen, batch, late, present) -> str:
    zero = "CAST(0 AS BIGINT)"
    once = run == 1
    days = "date_diff('day', min(submission_date) FILTER (WHERE {0}), max(submission_date) FILTER (WHERE {0})) + 61"

    def added(what):
        return f"count(DISTINCT {what}) FILTER (WHERE {staged}) - count(DISTINCT {what}) FILTER (WHERE {seen})"

    def rows(*rules):
        return f"count(*) FILTER (WHERE ({staged}) AND " + " AND ".join(f"({r})" for r in rules) + ")"

    return f"""
  SELECT CAST({run} AS BIGINT) AS run, '{mode}' AS mode,
         {f"any_value({mark})::VARCHAR" if mark else "CAST(NULL AS VARCHAR)"} AS watermark,
         any_value({after})::VARCHAR AS watermark_after, {rows(batch)} AS rows_extracted,
         {rows(batch, "known")} AS rows_transformed, {rows(batch, "NOT known")} AS rows_dropped,
         {rows(batch, "NOT known")} AS dropped_unresolved_product, {zero} AS dropped_unresolved_customer,
         {zero} AS dropped_unresolved_reviewer_profile, {zero} AS dropped_out_of_range_date,
         {rows(late, "known")} AS rows_late, {rows(late, "NOT known")} AS rows_late_unusable,
         {rows(batch, "known", f"NOT ({present})")} AS rows_inserted,
         {rows(batch, "known", present)} AS rows_already_present,
         {"(SELECT count(DISTINCT p_brand) FROM part WHERE p_size <= 48)" if once else zero} AS brand_inserted,
         {"(SELECT count(*) FROM part WHERE p_size <= 48)" if once else zero} AS product_inserted,
         {added("author_id")} AS customer_inserted,
         {added("(skin_tone, skin_type, eye_color, hair_color)")} AS profile_inserted,
         ({days.format(staged)}) - {zero if once else f"({days.format(seen)})"} AS date_inserted
  FROM runs, marks"""


_add("load_runs", " UNION ALL ".join(_run_sql(*rule) for rule in _run_rules), runs=_run_facts, **_run_marks)
_add("views_after_load", " UNION ALL ".join(
    f"SELECT '{view}' AS view_name, count(*) AS rows, sum({measure})::BIGINT AS reviews FROM ({_sql[name]})"
    for view, name, measure in (
        ("vw_rating_by_brand", "rating_by_brand", "review_count"),
        ("vw_rating_by_category", "rating_by_category", "review_count"),
        ("vw_review_trend_monthly", "review_trend_monthly", "review_count"),
        ("vw_rating_by_price_band", "rating_by_price_band", "review_count"),
        ("vw_rating_by_skin_type", "rating_by_profile_type", "review_count"),
        ("vw_kpi_summary", "kpi_summary", "total_reviews"),
        ("vw_hype_vs_reality", "hype_vs_reality", "review_count"),
        ("vw_review_volume_by_month", "volume_by_month", "review_count"),
        ("vw_rating_by_skin_tone", "rating_by_profile_tone", "review_count"),
        ("vw_rating_by_review_length", "rating_by_length", "review_count"),
        ("vw_rating_by_brand_category", "rating_by_brand_category", "review_count"))))
_add("ingest_counts", """
  SELECT 'good' AS step, p AS products, r AS reviews FROM n UNION ALL SELECT 'refused', p, r FROM n
  UNION ALL SELECT 'repeated', p, r FROM n UNION ALL SELECT 'appended', p + few, r + five FROM n""", n="""
  SELECT (SELECT count(*) FROM part) AS p, (SELECT count(*) FROM kept) AS r,
         (SELECT count(*) FROM part WHERE p_size % 4 = 1) AS few, (SELECT count(*) FROM kept WHERE rating = 5) AS five""")
_add("rank_fractions", """
  SELECT o_orderkey, percent_rank() OVER (ORDER BY CAST(o_totalprice AS DECIMAL(18,2))) AS price_rank,
         percent_rank() OVER (ORDER BY CAST(o_orderdate AS DATE)) AS day_rank,
         percent_rank() OVER (ORDER BY CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END NULLS LAST) AS priority_rank
  FROM orders""")
_add("layer_presence", """
  SELECT 'staging.product' AS table_name, true AS present, (SELECT count(*) FROM part) AS rows
  UNION ALL SELECT name, false, NULL FROM (VALUES ('staging.review'), ('raw.reviews'), ('dw.dim_customer')) t(name)""")
_add("preconditions", """
  SELECT precondition, broken, broken > 0 AS refused FROM (
    SELECT 'unique customer' AS precondition, count(*) - count(DISTINCT c_custkey) AS broken FROM customer
    UNION ALL SELECT 'unique lineitem', count(*) - count(DISTINCT l_orderkey) FROM lineitem
    UNION ALL SELECT 'dependency part', count(*) FILTER (n > 1)
      FROM (SELECT count(DISTINCT p_brand) AS n FROM part GROUP BY p_partkey)
    UNION ALL SELECT 'dependency orders', count(*) FILTER (n > 1)
      FROM (SELECT count(DISTINCT o_orderstatus) AS n FROM orders GROUP BY o_custkey))""")
_add("stored_layer_counts", " UNION ALL ".join(
    f"SELECT CAST({landing} AS BIGINT) AS landing, '{n}' AS table_name, {text} AS rows"
    for landing in (1, 2) for n, text in _layer_rows.items()))

# --- quality ---------------------------------------------------------------------------------

_gate = """SELECT *, source_row_id % 11 = 0 AS rated, source_row_id % 13 = 0 AS less, source_row_id % 17 = 0 AS pos,
                   source_row_id % 19 = 0 AS neg FROM known"""
_add("quality_report", """
  SELECT CAST(1 AS BIGINT) AS check_order, 'row_count' AS "check", 'hard_failure' AS severity,
         n >= 1 AS passed, printf('%d rows, at least 1 wanted', n) AS detail FROM q
  UNION ALL SELECT 2, 'no_null_keys', 'hard_failure', p + c + r + d = 0,
    printf('missing: product_key %d, customer_key %d, reviewer_profile_key %d, date_key %d', p, c, r, d) FROM q
  UNION ALL SELECT 3, 'no_negative_values', 'hard_failure', less + pos + neg = 0,
    printf('below zero: total_feedback_count %d, total_pos_feedback_count %d, total_neg_feedback_count %d',
           less, pos, neg) FROM q
  UNION ALL SELECT 4, 'unique_key', 'hard_failure', surplus = 0,
    printf('%d surplus rows by source_row_id, product_id', surplus) FROM q
  UNION ALL SELECT 5, 'value_range', 'hard_failure', rated = 0, printf('%d times rating is not 1 to 5', rated) FROM q
  UNION ALL SELECT 6, 'null_rate', 'warning', unasked <= 30,
    printf('%.2f%% of is_recommended missing, up to 30.00%% allowed', unasked) FROM q
  UNION ALL SELECT 7, 'null_rate', 'warning', unvoted <= 80,
    printf('%.2f%% of helpfulness missing, up to 80.00%% allowed', unvoted) FROM q""", gate=_gate,
     gated="SELECT * FROM gate UNION ALL SELECT * FROM gate WHERE source_row_id % 23 = 0", q="""
  SELECT count(*) AS n, count(*) FILTER (WHERE NOT coalesce(has_product, false)) AS p,
         count(*) FILTER (WHERE NOT coalesce(has_customer, false)) AS c,
         count(*) FILTER (WHERE NOT has_profile) AS r, count(*) FILTER (WHERE NOT has_date) AS d,
         count(*) FILTER (WHERE less) AS less, count(*) FILTER (WHERE pos) AS pos, count(*) FILTER (WHERE neg) AS neg,
         count(*) FILTER (WHERE rated) AS rated, count(*) - count(DISTINCT (source_row_id, product_id)) AS surplus,
         count(*) FILTER (WHERE is_recommended IS NULL) * 100::DOUBLE / count(*) AS unasked,
         count(*) FILTER (WHERE helpfulness IS NULL) * 100::DOUBLE / count(*) AS unvoted
  FROM gated""")
_add("product_quality_report", """
  SELECT CAST(1 AS BIGINT) AS check_order, 'row_count' AS "check", 'hard_failure' AS severity,
         count(*) >= 1 AS passed, printf('%d rows, at least 1 wanted', count(*)) AS detail FROM twice
  UNION ALL SELECT 2, 'no_null_keys', 'hard_failure', count(*) = 0, printf('missing: brand_key %d', count(*))
    FROM twice WHERE brand_key = 25
  UNION ALL SELECT 3, 'no_negative_values', 'hard_failure',
    count(*) FILTER (WHERE product_key % 10 = 0 OR product_key % 12 = 0) = 0,
    printf('below zero: price_usd %d, loves_count %d', count(*) FILTER (WHERE product_key % 10 = 0),
           count(*) FILTER (WHERE product_key % 12 = 0)) FROM twice
  UNION ALL SELECT 4, 'unique_key', 'hard_failure', count(*) = 0, printf('%d surplus rows by product_id', count(*))
    FROM product WHERE product_key % 14 = 0""",
     twice="SELECT * FROM product UNION ALL SELECT * FROM product WHERE product_key % 14 = 0")


def _faulted(table, name: str, columns: dict[str, str], number: str, source: str) -> str:
    """The rows of a table with the faults of the query, then one count per rule."""
    bad = list(BAD_VALUES[name].items())
    out = []
    for c, text in columns.items():
        for i, (column, value) in enumerate(bad):
            if c == column:
                text = f"CASE WHEN (number + {i}) % 31 = 0 THEN {value} ELSE {text} END"
        if c in table.required:
            text = f"CASE WHEN (number + {table.required.index(c)}) % 29 <> 0 THEN {text} END"
        out.append(f"{text} AS {c}")
    rows = f"SELECT {', '.join(out)} FROM (SELECT *, {number} AS number FROM {source})"
    rules = {f"not_null_{c}": f"{c} IS NULL" for c in table.required}
    rules |= {c: f"NOT ({rule})" for c, rule in table.checks.items()}
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS \"constraint\", count(*) FILTER (WHERE {test}) AS bad_rows "
        f"FROM ({rows})" for c, test in rules.items())


_review_columns = {c: c for c in (
    "source_row_id", "source_file", "author_id", "product_id", "submission_date", "rating", "helpfulness",
    "total_feedback_count", "total_pos_feedback_count", "total_neg_feedback_count")}
_review_columns |= {"review_id": "source_row_id", "review_length": "length(review_text)"}
_product_columns = {c: c for c in ("product_id", "product_name", "price_usd", "loves_count", "limited_edition", "new",
                                   "online_only", "out_of_stock", "retailer_exclusive")}
_product_columns |= {"brand_id": "brand_key", "category_id": "1", "child_count": "p_size % 4",
                     "reviews": "product_key % 500", "rating": "CASE WHEN product_key % 11 <> 0 THEN 1 + p_size % 5 END"}
_day_columns = {
    "date_key": "number", "full_date": "day", "year": "year(day)", "quarter": "quarter(day)", "month": "month(day)",
    "month_name": "monthname(day)", "week": "week(day)", "day": "day(day)", "day_of_week": "isodow(day)",
    "day_name": "dayname(day)", "is_weekend": "isodow(day) > 5"}
_add("constraint_report", " UNION ALL ".join((
    _faulted(NF_REVIEW, "nf.review", _review_columns, "source_row_id", "kept"),
    _faulted(NF_PRODUCT, "nf.product", _product_columns, "product_key", "product"),
    _faulted(DIM_DATE, "dw.dim_date", _day_columns, "CAST(strftime(day, '%Y%m%d') AS BIGINT)", "days"))), days="""
  SELECT unnest(generate_series(min(submission_date) - INTERVAL 30 DAY, max(submission_date) + INTERVAL 30 DAY,
                                INTERVAL 1 DAY))::DATE AS day FROM kept""")
_add("unique_report", """
  SELECT 'unique_product_id' AS "constraint", count(*) FILTER (WHERE p_partkey % 50 = 0) AS bad_rows FROM part
  UNION ALL SELECT 'unique_order_line', CAST(sum(n - 1) AS BIGINT)
  FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
_add("reference_report", """
  SELECT 'references_dim_product_product_key' AS "constraint",
         count(*) FILTER (WHERE NOT coalesce(has_product, false)) AS bad_rows FROM known
  UNION ALL SELECT 'references_dim_customer_customer_key',
    count(*) FILTER (WHERE NOT coalesce(has_customer, false)) FROM known
  UNION ALL SELECT 'references_dim_reviewer_profile_reviewer_profile_key',
    count(*) FILTER (WHERE NOT has_profile) FROM known
  UNION ALL SELECT 'references_dim_date_date_key', count(*) FILTER (WHERE NOT has_date) FROM known
  UNION ALL SELECT 'references_dim_brand_brand_key', count(*) FROM product WHERE p_size <= 48 AND brand_key = 25""")
_add("referential_check", """
  SELECT 'referential_integrity' AS "check", 'hard_failure' AS severity, count(*) = 0 AS passed,
         printf('%d times product_key is not in dim_product', count(*)) AS detail
  FROM known WHERE NOT coalesce(has_product, false)""")

# --- profiling -------------------------------------------------------------------------------

_add("profile_row_counts", f"""
  SELECT 'product_info' AS source, count(*) + count(*) FILTER (WHERE p_partkey % 50 = 0) AS rows,
         CAST({len(RAW_PRODUCT_COLUMNS)} AS BIGINT) AS columns FROM part
  UNION ALL SELECT source_file, count(*), NULL FROM files GROUP BY source_file
  UNION ALL SELECT 'reviews total', count(*), NULL FROM files""")
_null_rules = {
    "is_recommended": "is_recommended IS NULL", "helpfulness": "helpfulness IS NULL",
    "review_text": "review_text IS NULL", "review_title": "review_title IS NULL",
    "skin_tone": "o_orderpriority IS NULL", "eye_color": "c_mktsegment IS NULL",
    "price_usd": "l_tax IS NULL",
}
_full = ["source_row_id", "product_id", "rating", "total_feedback_count", "total_pos_feedback_count",
         "total_neg_feedback_count", "skin_type", "hair_color", "author_id", "product_name",
         "brand_name", "source_file"]
_add("profile_nulls", " UNION ALL ".join(
    [f"SELECT '{c}' AS measure, count(*) FILTER (WHERE {r}) AS nulls FROM files" for c, r in _null_rules.items()]
    + [f"SELECT '{c}', count(*) FILTER (WHERE {c} IS NULL) FROM files" for c in _full]
    + ["SELECT 'submission_time', count(*) FILTER (WHERE submission_date IS NULL) FROM files"]))
_catalogue = """
  SELECT * FROM cleaned
  UNION ALL SELECT * FROM cleaned WHERE CAST(product_id AS BIGINT) % 50 = 0"""
_blank = {"size": 0, "tertiary_category": 0, "rating": 0}
_add("profile_catalogue_nulls", " UNION ALL ".join(
    f"SELECT '{c}' AS measure, CAST({'0 * count(*)' if c in _blank else f'count(*) - count({c})'} AS BIGINT) AS nulls "
    f"FROM twice" for c in RAW_PRODUCT_COLUMNS), cleaned=_clean_product, twice=_catalogue)
_measures = {
    "duplicate_product_ids": "count(*) - count(DISTINCT product_id)",
    "brand_ids": "count(DISTINCT (brand_id, CAST(product_id AS BIGINT) % 3 = 0))",
    "brand_names": "count(DISTINCT brand_name)", "min_price": "min(price_usd)", "max_price": "max(price_usd)",
    "price_not_positive": "count(*) FILTER (WHERE price_usd <= 0)",
    "sale_above_price": "count(*) FILTER (WHERE sale_price_usd > price_usd)",
    "rating_out_of_range": "count(*) FILTER (WHERE rating NOT BETWEEN 1 AND 5)",
    "names_per_brand_id": "max(1)",
}
_add("profile_catalogue", " UNION ALL ".join(
    f"SELECT '{m}' AS measure, CAST({text} AS DOUBLE) AS value FROM twice" for m, text in _measures.items()),
     cleaned=_clean_product, twice=_catalogue)
_add("profile_categories", "SELECT primary_category, count(*) AS rows FROM twice GROUP BY 1",
     cleaned=_clean_product, twice=_catalogue)
_add("profile_reviews", """
  SELECT count(DISTINCT author_id) + count(DISTINCT author_id) FILTER (WHERE source_file = 'reviews_9.csv')
           AS authors,
         count(DISTINCT product_id) AS products, min(submission_date)::VARCHAR AS earliest,
         max(submission_date)::VARCHAR AS latest, CAST(0 AS BIGINT) AS unreadable_dates FROM files""")
_add("profile_years", "SELECT year(submission_date) AS year, count(*) AS rows FROM files GROUP BY 1")
_add("profile_ratings", "SELECT CAST(rating AS DOUBLE) AS rating, count(*) AS rows FROM files GROUP BY 1")
_written = "SELECT *, author_id || CASE source_file WHEN 'reviews_9.csv' THEN ' ' ELSE '' END AS author FROM files"
_add("profile_duplicates", """
  SELECT n - pairs AS pair_duplicates, n - triples AS triple_duplicates, triples - pairs AS difference
  FROM (SELECT count(*) AS n, count(DISTINCT (author, product_id)) AS pairs,
               count(DISTINCT (author, product_id, submission_date)) AS triples FROM written)""",
     written=_written)
_add("profile_orphans", """
  SELECT (SELECT count(*) FROM product WHERE p_size <= 48) AS products_known,
         count(DISTINCT product_id) AS products_reviewed,
         count(*) FILTER (WHERE product_id NOT IN (SELECT product_id FROM product WHERE p_size <= 48))
           AS orphan_rows FROM files""")
_add("profile_load_keys", """
  SELECT source_file, min(source_row_id) AS first_row, max(source_row_id) AS last_row,
         CAST(0 AS BIGINT) AS duplicate_keys FROM files GROUP BY source_file""")
_spelled = """SELECT author, o_orderpriority AS skin_tone, skin_type, c_mktsegment AS eye_color, hair_color
  FROM written"""
_per_author = "SELECT author, count(*) AS n, " + ", ".join(
    f"count(DISTINCT {a}) AS {a}" for a in PROFILE_ATTRIBUTES) + " FROM spelled GROUP BY author"
_mixed = " OR ".join(f"{a} > 1" for a in PROFILE_ATTRIBUTES)
_consistency = {"authors": "count(*)", "authors_mixed": f"count(*) FILTER (WHERE {_mixed})",
                "reviews_of_mixed_authors": f"coalesce(sum(n) FILTER (WHERE {_mixed}), 0)"}
for _a in PROFILE_ATTRIBUTES:
    _consistency[f"authors_several_{_a}"] = f"count(*) FILTER (WHERE {_a} > 1)"
    _consistency[f"most_{_a}"] = f"max({_a})"
_add("profile_attr_consistency", " UNION ALL ".join(
    f"SELECT '{m}' AS measure, CAST({text} AS BIGINT) AS value FROM authors" for m, text in _consistency.items()),
     written=_written, spelled=_spelled, authors=_per_author)
_add("profile_attr_combinations", """
  SELECT count(DISTINCT (skin_tone, skin_type, eye_color, hair_color)) AS present,
         count(DISTINCT skin_tone) * count(DISTINCT skin_type) * count(DISTINCT eye_color)
           * count(DISTINCT hair_color) AS possible FROM spelled""", written=_written, spelled=_spelled)
_add("profile_attr_values", """
  SELECT DISTINCT 'skin_tone' AS attribute,
         CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'notSureST' ELSE o_orderpriority END AS value FROM files
  UNION SELECT 'skin_type', skin_type FROM files
  UNION SELECT 'eye_color', CASE c_mktsegment WHEN 'FURNITURE' THEN 'Grey' ELSE c_mktsegment END FROM files
  UNION SELECT 'hair_color', hair_color FROM files""")
_levels = "SELECT *, coalesce(tertiary_category, '') AS tertiary FROM product"
_parents = """SELECT secondary_category, count(DISTINCT primary_category) AS parents FROM product GROUP BY 1"""
_add("profile_hierarchy", """
  SELECT count(DISTINCT primary_category) AS primary_category,
         count(DISTINCT secondary_category) AS secondary_category,
         count(DISTINCT tertiary) AS tertiary_category,
         count(DISTINCT (primary_category, secondary_category, tertiary)) AS triples,
         (SELECT max(parents) FROM parents) AS most_parents FROM levels""", levels=_levels, parents=_parents)
_add("profile_shared_secondaries", """SELECT * FROM parents WHERE parents > 1
     ORDER BY parents DESC, secondary_category LIMIT 10""", parents=_parents)
_add("profile_helpfulness", """
  SELECT count(*) FILTER (WHERE total_feedback_count = 0) AS no_votes,
         count(*) FILTER (WHERE helpfulness IS NULL) AS helpfulness_null,
         count(*) FILTER (WHERE (total_feedback_count = 0) <> (helpfulness IS NULL)) AS disagree,
         count(*) FILTER (WHERE total_pos_feedback_count + total_neg_feedback_count
                                <> total_feedback_count) AS split_mismatch FROM files""")
_add("profile_repeated_columns", """
  SELECT count(*) AS products_compared, count(*) AS product_name_differs, count(*) AS brand_name_differs,
         count(*) FILTER (WHERE tax IS DISTINCT FROM price_usd::DOUBLE) AS price_usd_differs
  FROM (SELECT product_id, min(l_tax) AS tax FROM files GROUP BY 1) LEFT JOIN product USING (product_id)""")
_tagged = "SELECT * FROM twice JOIN part ON p_partkey = CAST(product_id AS BIGINT)"
_add("profile_tags", """
  SELECT count(*) FILTER (WHERE p_size % 10 IN (0, 9)) AS products_without,
         CAST(2 AS DOUBLE) AS mean_tags, CAST(2 AS BIGINT) AS most_tags,
         2 * count(*) FILTER (WHERE p_size % 10 NOT IN (0, 9)) AS pairs,
         count(DISTINCT p_type) FILTER (WHERE p_size % 10 NOT IN (0, 9))
           + count(DISTINCT p_brand) FILTER (WHERE p_size % 10 NOT IN (0, 9)) AS distinct_tags
  FROM tagged""", cleaned=_clean_product, twice=_catalogue, tagged=_tagged)
_add("profile_top_tags", """
  SELECT tag, count(*) AS products
  FROM (SELECT p_type AS tag FROM tagged WHERE p_size % 10 NOT IN (0, 9)
        UNION ALL SELECT p_brand || '''s' FROM tagged WHERE p_size % 10 NOT IN (0, 9))
  GROUP BY tag ORDER BY products DESC, tag LIMIT 15""",
     cleaned=_clean_product, twice=_catalogue, tagged=_tagged)
_add("profile_cutoff", f"""
  SELECT count(*) FILTER (WHERE {_before}) AS before_cutoff,
         count(*) FILTER (WHERE NOT {_before}) AS from_cutoff, CAST(0 AS BIGINT) AS with_time FROM files""")
_add("profile_cutoff_months", f"""
  SELECT strftime(submission_date, '%Y-%m') AS month, count(*) AS rows
  FROM files WHERE NOT {_before} GROUP BY 1""")
_add("profile_text", """
  SELECT count(*) - count(text) AS missing, min(length(text)) AS min_length, max(length(text)) AS max_length,
         round(avg(length(text)), 0) AS mean_length, CAST(sum(length(text)) AS BIGINT) AS characters,
         CAST(floor(median(length(text))) AS BIGINT) AS median_length FROM documents""")

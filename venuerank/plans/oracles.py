"""SQL twins of the registered queries, for an independent engine over the same tables.

Each oracle is a chain of named subqueries; `sql` adds exactly those a query needs. Where the
engine under test works in parallel rounds or with shortcuts, the SQL states the plain rule:
metro areas, for example, are assigned by a sequential walk over the cities.
"""

from __future__ import annotations

from venuerank.functions.vocabulary import CUISINE_TAGS, FOOD_AND_DRINK_TAGS
from venuerank.plans.gold import TERM_ROUNDS
from venuerank.plans.queries import CITY, CUISINE, DAMAGED, FLAT_PENALTIES, MATCH, METRO, PHRASES, SAMPLE, TASTE, UNPROFILED, digits

AS_OF = "2002-01-01"
BLANKS = "(' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))"
SPLIT_LIMIT = "cccccccd"  # 80 % of the 32-bit range, rounded, in hex


def _texts(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _km(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    a = (
        f"least(greatest(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lng2} - {lng1}) / 2), 2), 0e0), 1e0)"
    )
    return f"(2 * 6371.0e0 * atan2(sqrt({a}), sqrt(1 - {a})))"


def _cell(lat: str, lng: str) -> str:
    parts = [f"printf('%.1f', floor({c} / 0.1e0) * 0.1e0)" for c in (lat, lng)]
    return " || '_' || ".join(parts)


def _popularity(rating: str, reviews: str, recency: str) -> str:
    return f"({rating} * 0.4e0 + ln({reviews} + 1) * 0.4e0 + {recency} * 0.2e0)"


def _full_stars(rating: str) -> str:
    return f"CAST(least(round_even(CAST({rating} AS DECIMAL(38,12)), 0), 5) AS INTEGER)"


def _satisfaction(rate: str) -> str:
    return f"((positive_count + 30 * {rate}) / (positive_count + negative_count + 30) * 10)"


# name -> (subqueries it reads, SQL)
PARTS: dict[str, tuple[list[str], str]] = {
    "business": ([], """
        SELECT CAST(p_partkey AS VARCHAR) AS business_id, p_name AS name,
               ' ciTY ' || CAST(p_partkey % 25 AS VARCHAR) || ' ' AS city,
               CASE WHEN p_partkey % 2 = 0 THEN 'az' ELSE 'nv ' END AS state,
               CASE WHEN p_partkey % 41 <> 0
                    THEN 30 + (p_partkey % 25) * 0.23e0 + (p_partkey % 7) * 0.031e0 END AS latitude,
               -110 + (p_partkey % 2) * 8 - (p_partkey % 25) * 0.17e0 - (p_partkey % 11) * 0.027e0 AS longitude,
               CASE WHEN p_size % 7 = 0 THEN 0 ELSE 1 END AS is_open,
               CASE p_type WHEN 'ECONOMY' THEN 'Fast Food, Restaurants' WHEN 'LARGE' THEN 'Steakhouses , Restaurants'
                    WHEN 'MEDIUM' THEN 'Bars, Nightlife' WHEN 'PROMO' THEN 'Active Life, Yoga'
                    WHEN 'SMALL' THEN 'Mexican, Restaurants' ELSE 'Coffee & Tea' END AS categories,
               CAST(5 + p_size * 9 AS BIGINT) AS review_count
        FROM part"""),
    "document_count": ([], "SELECT count(*) AS n FROM documents"),
    "line": (["document_count"], """
        SELECT l.*, l_orderkey % n AS doc_id,
               concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER)) AS review_id
        FROM lineitem l, document_count"""),
    "review": (["line"], """
        SELECT review_id, CAST(l_partkey AS VARCHAR) AS business_id, CAST(o_custkey AS VARCHAR) AS user_id,
               1 + (CAST(l_quantity AS INTEGER) - 1) % 5 AS stars,
               strftime(l_shipdate, '%Y-%m-%d 00:00:00') AS date,
               CASE WHEN NOT (l_linenumber = 7 AND l_quantity > 45) THEN d.text END AS text
        FROM line JOIN orders ON o_orderkey = l_orderkey JOIN documents d ON d.doc_id = line.doc_id"""),
    "clean_review": (["review"], """
        SELECT * FROM review
        WHERE review_id IS NOT NULL AND business_id IS NOT NULL AND user_id IS NOT NULL
          AND stars IS NOT NULL AND date IS NOT NULL AND text IS NOT NULL"""),
    "tidy": (["business"], f"""
        SELECT business_id, is_open, name, latitude, longitude, categories, review_count,
               upper(trim(city)[1]) || lower(trim(city)[2:]) AS city, upper(trim(state)) AS state,
               upper(trim(city)[1]) || lower(trim(city)[2:]) || '_' || upper(trim(state)) AS city_key
        FROM business
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND is_open = 1
          AND list_has_any(list_transform(string_split(categories, ','), lambda t: lower(trim(t))),
                           [{_texts(FOOD_AND_DRINK_TAGS)}])"""),
    "city_anchor": (["tidy"], """
        SELECT city_key, city, state, avg(latitude) AS center_lat, avg(longitude) AS center_lng,
               CAST(sum(review_count) AS BIGINT) AS total_reviews
        FROM tidy GROUP BY ALL"""),
    "turns": (["city_anchor"], """
        SELECT *, row_number() OVER (ORDER BY total_reviews DESC, city_key) AS turn FROM city_anchor"""),
    "walk": (["turns"], f"""
        SELECT CAST(0 AS BIGINT) AS turn,
               CAST([] AS STRUCT(city_key VARCHAR, city VARCHAR, state VARCHAR, lat DOUBLE, lng DOUBLE)[]) AS anchors
        UNION ALL
        SELECT t.turn,
               CASE WHEN len(list_filter(w.anchors, lambda a: {_km('t.center_lat', 't.center_lng', 'a.lat', 'a.lng')} <= 50)) > 0
                    THEN w.anchors
                    ELSE list_append(w.anchors, {{'city_key': t.city_key, 'city': t.city, 'state': t.state,
                                                  'lat': t.center_lat, 'lng': t.center_lng}}) END
        FROM walk w JOIN turns t ON t.turn = w.turn + 1"""),
    "anchor": (["walk"], """
        SELECT unnest(anchors, recursive := true), generate_subscripts(anchors, 1) AS place
        FROM walk WHERE turn = (SELECT max(turn) FROM walk)"""),
    "named_anchor": (["anchor"], """
        SELECT *, CASE WHEN row_number() OVER (PARTITION BY city ORDER BY place) = 1
                       THEN city ELSE city || ', ' || state END AS metro_area
        FROM anchor"""),
    "metro_map": (["named_anchor", "city_anchor"], f"""
        SELECT c.city_key, arg_min(a.metro_area, a.place) AS metro_area, arg_min(a.city_key, a.place) AS anchor_key,
               arg_min({_km('a.lat', 'a.lng', 'c.center_lat', 'c.center_lng')}, a.place) AS distance_km
        FROM city_anchor c JOIN named_anchor a
          ON {_km('a.lat', 'a.lng', 'c.center_lat', 'c.center_lng')} <= 50
        GROUP BY c.city_key"""),
    "venue": (["tidy", "metro_map"], f"""
        SELECT business_id, is_open, name, city, state, latitude, longitude, categories, review_count, metro_area,
               {_cell('latitude', 'longitude')} AS grid_cell
        FROM tidy JOIN metro_map USING (city_key)"""),
    "enriched": (["clean_review", "venue"], f"""
        SELECT r.*, v.* EXCLUDE (business_id),
               1 / (1 + date_diff('day', CAST(CAST(r.date AS TIMESTAMP) AS DATE), DATE '{AS_OF}') / 365.0e0) AS recency_weight
        FROM clean_review r JOIN venue v USING (business_id)"""),
    "scores": (["enriched"], f"""
        SELECT *, {_popularity('avg_rating', 'review_count', 'recency_score')} AS popularity_score
        FROM (SELECT business_id, name, metro_area, city, latitude, longitude, grid_cell, categories,
                     avg(stars) AS avg_rating, count(*) AS review_count,
                     sum(recency_weight) / count(*) AS recency_score
              FROM enriched GROUP BY ALL)"""),
    "category_rank": (["scores"], """
        SELECT grid_cell, metro_area, categories,
               row_number() OVER (PARTITION BY grid_cell, metro_area
                                  ORDER BY count(*) DESC, categories NULLS FIRST) AS place
        FROM scores GROUP BY grid_cell, metro_area, categories"""),
    "grid": (["scores", "category_rank"], """
        SELECT s.grid_cell, s.metro_area, avg(latitude) AS center_lat, avg(longitude) AS center_lng,
               avg(popularity_score) AS avg_popularity, count(*) AS restaurant_count,
               any_value(r.categories) AS top_cuisine
        FROM scores s JOIN category_rank r
          ON r.grid_cell = s.grid_cell AND r.metro_area = s.metro_area AND r.place = 1
        GROUP BY s.grid_cell, s.metro_area"""),
    "sentiment": (["enriched"], """
        SELECT grid_cell, positive_count / (positive_count + negative_count) AS sentiment_score,
               positive_count, negative_count
        FROM (SELECT grid_cell, count(*) FILTER (stars >= 4) AS positive_count,
                     count(*) FILTER (stars <= 2) AS negative_count FROM enriched GROUP BY grid_cell)
        WHERE positive_count + negative_count > 0"""),
    "cell_sentiment": (["grid", "sentiment"], """
        SELECT g.metro_area, g.grid_cell, center_lat, center_lng, restaurant_count,
               coalesce(sentiment_score, 0) AS sentiment_score, coalesce(positive_count, 0) AS positive_count,
               coalesce(negative_count, 0) AS negative_count
        FROM grid g LEFT JOIN sentiment s ON s.grid_cell = g.grid_cell"""),
    "offsets": (["grid"], """
        SELECT g.*, CAST(split_part(grid_cell, '_', 1) AS DOUBLE) + 0.05e0 - city_lat AS d_lat,
               CAST(split_part(grid_cell, '_', 2) AS DOUBLE) + 0.05e0 - city_lng AS d_lng
        FROM grid g JOIN (SELECT metro_area, avg(center_lat) AS city_lat, avg(center_lng) AS city_lng
                          FROM grid GROUP BY metro_area) c USING (metro_area)"""),
    "bearings": (["offsets"], """
        SELECT *, sqrt(d_lat * d_lat + d_lng * d_lng) AS distance,
               CASE WHEN 90 - degrees(atan2(d_lat, d_lng)) < 0 THEN 450 - degrees(atan2(d_lat, d_lng))
                    ELSE 90 - degrees(atan2(d_lat, d_lng)) END AS bearing
        FROM offsets"""),
    "plain_label": (["bearings"], """
        SELECT *, CASE WHEN distance < 0.1 THEN 'Downtown' ELSE
               CASE WHEN bearing < 22.5 OR bearing >= 337.5 THEN 'North' WHEN bearing < 67.5 THEN 'Northeast'
                    WHEN bearing < 112.5 THEN 'East' WHEN bearing < 157.5 THEN 'Southeast'
                    WHEN bearing < 202.5 THEN 'South' WHEN bearing < 247.5 THEN 'Southwest'
                    WHEN bearing < 292.5 THEN 'West' ELSE 'Northwest' END
               || CASE WHEN distance < 0.25 THEN ' District' WHEN distance < 0.45 THEN ' Side' ELSE ' Outskirts' END
               END AS label
        FROM bearings"""),
    "labelled": (["plain_label"], """
        SELECT *, CASE WHEN count(*) OVER (PARTITION BY metro_area, label) > 1
                       THEN label || ' ' || row_number() OVER (PARTITION BY metro_area, label ORDER BY grid_cell)
                       ELSE label END AS neighborhood
        FROM plain_label"""),
    "bayes": (["grid", "sentiment"], f"""
        SELECT *, {_satisfaction('global_rate')} AS bayesian_score,
               positive_count / greatest(positive_count + negative_count, 1) AS raw_score
        FROM (SELECT s.*, g.metro_area, g.restaurant_count,
                     sum(positive_count) OVER () / sum(positive_count + negative_count) OVER () AS global_rate
              FROM sentiment s LEFT JOIN grid g ON g.grid_cell = s.grid_cell)"""),
    "snippet": (["enriched"], """
        SELECT business_id, substring(text, 1, 120) AS snippet,
               row_number() OVER (PARTITION BY business_id ORDER BY date DESC, review_id) AS place
        FROM enriched"""),
    "profile": (["snippet", "scores"], f"""
        SELECT business_id, name, metro_area, city, latitude, longitude, avg_rating, review_count, popularity_score,
               trim(trim(categories) || ' ' || trim(categories) || ' ' || trim(categories) || ' ' || snippets,
                    {BLANKS}) AS profile_text
        FROM scores JOIN (SELECT business_id, string_agg(snippet, ' ' ORDER BY place) AS snippets
                          FROM snippet WHERE place <= 20 GROUP BY business_id) USING (business_id)"""),
    "words": (["enriched", "scores"], r"""
        SELECT metro_area, business_id, 1 AS times, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS w FROM enriched
        UNION ALL
        SELECT metro_area, business_id, 3, regexp_extract_all(lower(categories), '[\p{L}\p{N}_]{2,}') FROM scores"""),
    "terms": (["words"], """
        SELECT metro_area, business_id, term, CAST(sum(times) AS BIGINT) AS tf
        FROM (SELECT metro_area, business_id, times,
                     unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term
              FROM words)
        GROUP BY ALL"""),
    "vocabulary": (["terms", "scores"], """
        SELECT metro_area, term, corpus_count, doc_count, ln((1 + n) / (1 + doc_count)) + 1 AS idf
        FROM (SELECT metro_area, term, CAST(sum(tf) AS BIGINT) AS corpus_count, count(*) AS doc_count
              FROM terms GROUP BY metro_area, term)
        JOIN (SELECT metro_area, count(*) AS n FROM scores GROUP BY ALL) USING (metro_area)"""),
    "weights": (["terms", "vocabulary"], """
        SELECT metro_area, business_id, term,
               raw / sqrt(sum(raw * raw) OVER (PARTITION BY metro_area, business_id)) AS weight
        FROM (SELECT t.metro_area, business_id, t.term, (1 + ln(tf)) * idf AS raw
              FROM terms t JOIN vocabulary v ON v.metro_area = t.metro_area AND v.term = t.term)"""),
    "question": (["scores"], "SELECT metro_area || '/' || number AS query_id, metro_area, query FROM "
                 "(SELECT DISTINCT metro_area FROM scores), (VALUES "
                 + ", ".join(f"('{i}', {_texts([p])})" for i, p in enumerate(PHRASES))
                 + ") AS p(number, query)"),
    "question_term": (["question"], r"""
        SELECT query_id, metro_area, term, count(*) AS tf
        FROM (SELECT query_id, metro_area,
                     unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term
              FROM (SELECT *, regexp_extract_all(lower(query), '[\p{L}\p{N}_]{2,}') AS w FROM question))
        GROUP BY ALL"""),
    "question_weight": (["question_term", "vocabulary"], """
        SELECT query_id, metro_area, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY query_id)) AS weight
        FROM (SELECT query_id, q.metro_area, q.term, (1 + ln(tf)) * idf AS raw
              FROM question_term q JOIN vocabulary v ON v.metro_area = q.metro_area AND v.term = q.term)"""),
    "matched": (["question_weight", "weights"], """
        SELECT query_id, business_id, sum(q.weight * w.weight) AS match_score
        FROM question_weight q JOIN weights w ON w.metro_area = q.metro_area AND w.term = q.term GROUP BY ALL"""),
    "blended": (["question", "profile", "matched"], """
        SELECT q.query_id, p.* EXCLUDE (profile_text), coalesce(match_score, 0) AS match_score,
               0.6e0 * coalesce(match_score, 0)
               + (0.25e0 * (ln(1 + p.review_count)
                            / max(ln(1 + p.review_count)) OVER (PARTITION BY q.query_id))
                  + 0.15e0 * (p.avg_rating / 5)) AS final_score
        FROM question q JOIN profile p ON p.metro_area = q.metro_area
        LEFT JOIN matched m ON m.query_id = q.query_id AND m.business_id = p.business_id"""),
    "found": (["blended"], f"""
        SELECT * FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id
                                              ORDER BY round(final_score, 9) DESC, business_id) AS INTEGER) AS position
            FROM blended)
        WHERE position <= 10 AND match_score > {MATCH}"""),
    "rating": (["enriched"], """
        SELECT review_id, user_id, business_id, CAST(stars AS FLOAT) AS stars FROM enriched"""),
    "recommendation": (["rating"], """
        SELECT user_id, business_id, avg(stars) AS predicted_rating,
               CAST(row_number() OVER (PARTITION BY user_id ORDER BY avg(stars) DESC, business_id) AS INTEGER) AS rank
        FROM rating GROUP BY user_id, business_id
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY avg(stars) DESC, business_id) <= 10"""),
    "located": (["recommendation", "scores"], f"""
        SELECT r.user_id, '{METRO}' AS requested_metro, rank, predicted_rating, s.business_id, name, city, metro_area,
               categories, avg_rating, review_count, latitude, longitude,
               coalesce(bool_or(metro_area = '{METRO}') OVER (PARTITION BY r.user_id), false) AS city_filtered
        FROM recommendation r JOIN scores s ON s.business_id = r.business_id"""),
    "shown": (["located"], """
        SELECT * FROM located WHERE NOT city_filtered OR metro_area = requested_metro
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rank, business_id) <= 20"""),
    "taste": (["recommendation", "scores"], f"""
        SELECT user_id, count(*) AS matches, avg(predicted_rating) AS avg_pred
        FROM recommendation r JOIN scores s ON s.business_id = r.business_id
        WHERE metro_area = '{METRO}'
          AND ({' OR '.join(f"contains(lower(categories), lower('{t}'))" for t in TASTE)})
        GROUP BY user_id"""),
    "mean_prediction": (["rating", "scores"], """
        SELECT r.stars, s.avg_rating AS prediction FROM rating r JOIN scores s ON s.business_id = r.business_id"""),
    "rmse": (["mean_prediction"], """
        SELECT sqrt(avg((CAST(stars AS DOUBLE) - prediction) ** 2)) AS rmse FROM mean_prediction"""),
    "judged": ([], """
        SELECT quality AS label, CASE WHEN length(d.text) > 1000 THEN 1 ELSE 0 END AS prediction
        FROM documents d JOIN labels l ON l.doc_id = d.doc_id"""),
    "per_label": (["judged"], """
        SELECT c.label, count(*) FILTER (j.label = c.label) AS actual,
               count(*) FILTER (j.prediction = c.label) AS guessed,
               count(*) FILTER (j.label = c.label AND j.prediction = c.label) AS hits
        FROM judged j, (SELECT DISTINCT label FROM judged) c GROUP BY c.label"""),
    "f1": (["per_label"], """
        SELECT sum(hits) / sum(actual) AS accuracy,
               sum(2 * hits / (actual + guessed) * actual) / sum(actual) AS weighted_f1
        FROM per_label"""),
    "train": (["rating"], f"SELECT * FROM rating WHERE substring(md5('42:' || review_id), 1, 8) < '{SPLIT_LIMIT}'"),
    "held": ([], """
        SELECT CAST(quality AS INTEGER) AS label, CAST(round(count(*) * 0.2e0) AS BIGINT) AS held_out
        FROM documents d JOIN labels l ON l.doc_id = d.doc_id GROUP BY quality"""),
    "precision_at": (["recommendation"], """
        SELECT coalesce(avg(share), 0) AS precision_at_k
        FROM (SELECT avg(CASE WHEN predicted_rating >= 4 THEN 1 ELSE 0 END) AS share
              FROM recommendation WHERE rank <= 10 GROUP BY user_id)"""),
    "measure": (["scores"], """
        UNPIVOT (SELECT avg_rating, CAST(review_count AS DOUBLE) AS review_count, recency_score, popularity_score FROM scores)
        ON avg_rating, review_count, recency_score, popularity_score INTO NAME metric VALUE value"""),
    "places": (["scores"], """
        SELECT business_id, name, avg_rating, review_count, popularity_score,
               row_number() OVER (ORDER BY round(avg_rating, 9) DESC, business_id) - 1 AS rank_raw,
               row_number() OVER (ORDER BY round(popularity_score, 9) DESC, business_id) - 1 AS rank_pop
        FROM scores"""),
}

# Alternating least squares with one factor, written out round by round: each side's factor is the quotient of two sums.
# The first penalty's parts are named flat_.., the others' flat_1_.., flat_2_..
FLAT_ROUNDS = 3
FLAT = ["flat", *[f"flat_{i}" for i in range(1, len(FLAT_PENALTIES))]]
for _flat, _penalty in zip(FLAT, FLAT_PENALTIES):
    for _k in range(1, FLAT_ROUNDS + 1):
        for _side, _id, _other, _other_id, _before in (
            ("user", "user_id", "business", "business_id", _k - 1), ("business", "business_id", "user", "user_id", _k),
        ):
            _sums = f"sum(CAST(t.stars AS DOUBLE) * o.x) / (sum(o.x * o.x) + {_penalty}e0 * count(*))"
            PARTS[f"{_flat}_{_side}_{_k}"] = (["train", f"{_flat}_{_other}_{_before}"], f"""
                SELECT t.{_id} AS id, {_sums} AS x FROM train t JOIN {_flat}_{_other}_{_before} o ON o.id = t.{_other_id} GROUP BY t.{_id}""")
    PARTS[f"{_flat}_business_0"] = (["train"], "SELECT DISTINCT business_id AS id, 1e0 AS x FROM train")
    PARTS[f"{_flat}_prediction"] = (["rating", "train", f"{_flat}_user_{FLAT_ROUNDS}", f"{_flat}_business_{FLAT_ROUNDS}"], f"""
        SELECT r.review_id, r.stars, u.x * b.x AS prediction
        FROM rating r JOIN {_flat}_user_{FLAT_ROUNDS} u ON u.id = r.user_id JOIN {_flat}_business_{FLAT_ROUNDS} b ON b.id = r.business_id
        WHERE r.review_id NOT IN (SELECT review_id FROM train)""")
PARTS["flat_error"] = ([f"{flat}_prediction" for flat in FLAT], " UNION ALL ".join(
    f"SELECT {penalty}e0 AS reg_param, sqrt(avg((CAST(stars AS DOUBLE) - prediction) ** 2)) AS rmse FROM {flat}_prediction"
    for flat, penalty in zip(FLAT, FLAT_PENALTIES)))

# The table-based classifier, step by step: TF-IDF of whole texts, then accelerated gradient steps from zero.
PARTS |= {
    "verdict": ([], """
        SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || review_id), review_id)
                  <= round(count(*) OVER (PARTITION BY label) * 0.2e0) AS is_test
        FROM (SELECT CAST(d.doc_id AS VARCHAR) AS review_id, CAST(quality = 1 AS INTEGER) AS label, text
              FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""),
    "verdict_term": (["verdict"], r"""
        SELECT review_id, is_test, term, count(*) AS tf
        FROM (SELECT review_id, is_test,
                     unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term
              FROM (SELECT *, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS w FROM verdict))
        GROUP BY ALL"""),
    "verdict_size": (["verdict"], "SELECT count(*) AS n FROM verdict WHERE NOT is_test"),
    "verdict_idf": (["verdict_term", "verdict_size"], """
        SELECT term, ln((any_value(n) + 1e0) / (count(*) + 1)) + 1 AS idf FROM verdict_term, verdict_size WHERE NOT is_test GROUP BY term"""),
    "verdict_value": (["verdict_term", "verdict_idf"], """
        SELECT review_id, is_test, term, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY review_id)) AS x
        FROM verdict_term JOIN verdict_idf USING (term)"""),
    "step_weight_0": (["verdict_idf"], "SELECT term, 0e0 AS last, 0e0 AS weight FROM verdict_idf"),
    "step_intercept_0": ([], "SELECT 0e0 AS last, 0e0 AS intercept"),
}
for _k in range(1, TERM_ROUNDS + 1):
    PARTS[f"step_residual_{_k}"] = (["verdict", "verdict_value", f"step_weight_{_k - 1}", f"step_intercept_{_k - 1}"], f"""
        SELECT d.review_id, 1 / (1 + exp(-(coalesce(s.margin, 0) + i.intercept))) - d.label AS residual
        FROM verdict d JOIN step_intercept_{_k - 1} i ON true LEFT JOIN (
            SELECT review_id, sum(x * weight) AS margin FROM verdict_value v JOIN step_weight_{_k - 1} USING (term)
            WHERE NOT is_test GROUP BY review_id) s ON s.review_id = d.review_id
        WHERE NOT d.is_test""")
    PARTS[f"step_weight_{_k}"] = (["verdict_value", "verdict_size", f"step_residual_{_k}", f"step_weight_{_k - 1}"], f"""
        SELECT term, moved AS last, moved + {_k - 1} / {_k + 2}e0 * (moved - last) AS weight
        FROM (SELECT w.term, last, weight - (pull + weight) / n / (0.5e0 + 1e0 / n) AS moved
              FROM step_weight_{_k - 1} w JOIN verdict_size ON true JOIN (
                  SELECT term, sum(x * residual) AS pull FROM verdict_value v JOIN step_residual_{_k} r ON r.review_id = v.review_id
                  GROUP BY term) p ON p.term = w.term)""")
    PARTS[f"step_intercept_{_k}"] = (["verdict_size", f"step_residual_{_k}", f"step_intercept_{_k - 1}"], f"""
        SELECT moved AS last, moved + {_k - 1} / {_k + 2}e0 * (moved - last) AS intercept
        FROM (SELECT i.last, i.intercept - (SELECT avg(residual) FROM step_residual_{_k}) / (0.5e0 + 1e0 / n) AS moved
              FROM step_intercept_{_k - 1} i, verdict_size)""")
PARTS["term_verdict"] = (["verdict", "verdict_value", f"step_weight_{TERM_ROUNDS}", f"step_intercept_{TERM_ROUNDS}"], f"""
    SELECT d.review_id, label, 1 / (1 + exp(-margin)) AS probability, CASE WHEN round(margin, 9) > 0 THEN 1 ELSE 0 END AS prediction
    FROM (SELECT d.review_id, d.label, coalesce(sum(v.x * w.last), 0) + any_value(i.last) AS margin
          FROM verdict d JOIN step_intercept_{TERM_ROUNDS} i ON true LEFT JOIN verdict_value v ON v.review_id = d.review_id
          LEFT JOIN step_weight_{TERM_ROUNDS} w ON w.term = v.term
          WHERE d.is_test GROUP BY d.review_id, d.label) d""")
PARTS["term_per_label"] = (["term_verdict"], """
    SELECT c.label, count(*) FILTER (j.label = c.label) AS actual, count(*) FILTER (j.prediction = c.label) AS guessed,
           count(*) FILTER (j.label = c.label AND j.prediction = c.label) AS hits
    FROM term_verdict j, (SELECT DISTINCT label FROM term_verdict) c GROUP BY c.label""")

# Subqueries read more than once, or too large to be inlined.
_STORED = {"review", "clean_review", "venue", "enriched", "scores", "grid", "terms", "vocabulary", "weights", "profile"}
_STORED |= {"train", "term_verdict"} | {name for name in PARTS if name.startswith(("flat_", "step_", "verdict"))}


def sql(query: str, *needs: str) -> str:
    """`query` behind the subqueries it needs, each after those it reads."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in PARTS[name][0]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    chain = [f"{n} AS {'MATERIALIZED ' if n in _STORED else ''}({PARTS[n][1].strip()})" for n in ordered]
    return (f"WITH RECURSIVE {', '.join(chain)} " if chain else "") + query.strip()


def _r(*columns: str) -> str:
    return ", ".join(f"round({c}, {digits(c)}) AS {c}" for c in columns)


_SCORE_ROW = "business_id, name, metro_area, city, grid_cell, categories, review_count, " + _r(
    "latitude", "longitude", "avg_rating", "recency_score", "popularity_score"
)
_PROFILE_ROW = "business_id, name, metro_area, city, review_count, profile_text, " + _r(
    "latitude", "longitude", "avg_rating", "popularity_score"
)
_VENUE_ROW = "business_id, is_open, name, city, state, categories, review_count, metro_area, " + _r("latitude", "longitude")


def _rounded(value: str, name: str) -> str:
    return f"round({value}, {digits(name)}) AS {name}"


def _single_line(column: str) -> str:
    return f"translate({column}, chr(9) || chr(10) || chr(13) || '\\', '   ') AS {column}"


def _band(value: str, high: str, medium: str, names: tuple[str, str, str]) -> str:
    return f"CASE WHEN {value} >= {high} THEN '{names[0]}' WHEN {value} >= {medium} THEN '{names[1]}' ELSE '{names[2]}' END"


_SENTIMENT = sql("SELECT grid_cell, positive_count, negative_count, " + _r("sentiment_score") + " FROM sentiment", "sentiment")
_SCORES = sql(f"SELECT {_SCORE_ROW} FROM scores", "scores")

ORACLES: dict[str, str] = {
    "business_scores": _SCORES,
    "business_scores_grouped": _SCORES,
    "clean_businesses": sql(f"SELECT {_VENUE_ROW} FROM venue", "venue"),
    "clean_reviews": sql("SELECT * FROM clean_review", "clean_review"),
    "reviews_enriched": sql(
        "SELECT review_id, business_id, user_id, stars, date, text, is_open, name, city, state, categories,"
        " review_count, metro_area, grid_cell, " + _r("latitude", "longitude", "recency_weight") + " FROM enriched",
        "enriched"),
    "city_anchors": sql(
        "SELECT city_key, city, state, total_reviews, " + _r("center_lat", "center_lng") + " FROM city_anchor",
        "city_anchor"),
    "city_priority": sql("SELECT city_key, total_reviews, turn - 1 AS turn FROM turns", "turns"),
    "venue_distance": sql(
        f"SELECT business_id, city_key, round({_km('latitude', 'longitude', 'center_lat', 'center_lng')}, 6) AS distance_km"
        " FROM tidy JOIN city_anchor USING (city_key)", "city_anchor"),
    "metro_map": sql("SELECT city_key, metro_area, anchor_key, " + _r("distance_km") + " FROM metro_map", "metro_map"),
    "top_cuisine": sql(
        "SELECT grid_cell, metro_area, categories AS top_cuisine FROM category_rank WHERE place = 1", "category_rank"),
    "grid_aggregates": sql(
        "SELECT grid_cell, metro_area, restaurant_count, top_cuisine, "
        + _r("center_lat", "center_lng", "avg_popularity") + " FROM grid", "grid"),
    "grid_sentiment": _SENTIMENT,
    "grid_sentiment_pivot": _SENTIMENT,
    "cell_sentiment": sql(
        "SELECT metro_area, grid_cell, restaurant_count, positive_count, negative_count, "
        + _r("center_lat", "center_lng", "sentiment_score") + " FROM cell_sentiment", "cell_sentiment"),
    "satisfaction_ranking": sql(f"""
        SELECT metro_area, grid_cell, neighborhood, satisfaction, positive_count, negative_count, restaurant_count,
               CAST(row_number() OVER (PARTITION BY metro_area ORDER BY satisfaction DESC, grid_cell) AS INTEGER) AS position
        FROM (SELECT c.*, neighborhood,
                     CAST(round_even(CAST({_satisfaction('metro_rate')} AS DECIMAL(38,12)), 1) AS DOUBLE) AS satisfaction
              FROM (SELECT *, coalesce(sum(positive_count) OVER (PARTITION BY metro_area)
                              / nullif(sum(positive_count + negative_count) OVER (PARTITION BY metro_area), 0), 0.5e0) AS metro_rate
                    FROM cell_sentiment) c
              JOIN labelled l ON l.metro_area = c.metro_area AND l.grid_cell = c.grid_cell)""",
        "cell_sentiment", "labelled"),
    "bayesian_cells": sql(
        "SELECT grid_cell, positive_count, negative_count, metro_area, restaurant_count, "
        + _band("bayesian_score", "8", "6", ("#c62828", "#e65100", "#2e7d32")) + " AS band, "
        + _r("sentiment_score", "global_rate", "raw_score", "bayesian_score") + " FROM bayes", "bayes"),
    "spatial_coverage": sql(
        "SELECT g.metro_area, g.grid_cell, g.restaurant_count, "
        + _r("center_lat", "center_lng", "avg_popularity", "bayesian_score")
        + " FROM grid g LEFT JOIN bayes b ON b.grid_cell = g.grid_cell AND b.metro_area = g.metro_area", "grid", "bayes"),
    "sentiment_chart": sql(
        "SELECT metro_area, grid_cell AS cell, round(raw_score * 10, 6) AS raw,"
        " round(global_rate * 10, 6) AS city_average, "
        + _band("bayesian_score", "8", "6", ("#c62828", "#e65100", "#2e7d32")) + " AS band, "
        + _r("bayesian_score") + " FROM bayes", "bayes"),
    "metro_centres": sql(
        "SELECT metro_area, " + _r("city_lat", "city_lng")
        + " FROM (SELECT metro_area, avg(center_lat) AS city_lat, avg(center_lng) AS city_lng FROM grid GROUP BY metro_area)",
        "grid"),
    "largest_cells": sql("""
        SELECT metro_area, grid_cell FROM grid
        QUALIFY row_number() OVER (PARTITION BY metro_area ORDER BY restaurant_count DESC, grid_cell) <= 10""", "grid"),
    "neighborhood_labels": sql(
        "SELECT metro_area, grid_cell, restaurant_count, neighborhood, " + _r("center_lat", "center_lng")
        + " FROM labelled", "labelled"),
    "cell_bounds": sql(f"""
        SELECT metro_area, grid_cell, neighborhood, top_cuisine, restaurant_count, {_r('avg_popularity')},
               round(CAST(split_part(grid_cell, '_', 1) AS DOUBLE), 6) AS south,
               round(CAST(split_part(grid_cell, '_', 2) AS DOUBLE), 6) AS west,
               round(CAST(split_part(grid_cell, '_', 1) AS DOUBLE) + 0.1e0, 6) AS north,
               round(CAST(split_part(grid_cell, '_', 2) AS DOUBLE) + 0.1e0, 6) AS east
        FROM labelled""", "labelled"),
    "heat_points": sql(f"""
        SELECT metro_area, grid_cell, {_r('center_lat', 'center_lng', 'weight')},
               {_band('weight', '0.7', '0.4', ('#c62828', '#ef6c00', '#2e7d32'))} AS colour
        FROM (SELECT *, (avg_popularity - min(avg_popularity) OVER m)
                        / greatest(CASE WHEN max(avg_popularity) OVER m = 0 THEN 1 ELSE max(avg_popularity) OVER m END
                                   - min(avg_popularity) OVER m, 1e-6) AS weight
              FROM grid WINDOW m AS (PARTITION BY metro_area))""", "grid"),
    "pin_classes": sql(f"""
        SELECT metro_area, position, business_id, name, categories, review_count,
               {_r('latitude', 'longitude', 'avg_rating', 'popularity_score')},
               {_band('norm', '0.7', '0.4', ('green', 'orange', 'lightgray'))} AS pin_class
        FROM (SELECT *, (popularity_score - min(popularity_score) OVER m)
                        / greatest(max(popularity_score) OVER m - min(popularity_score) OVER m, 1e-6) AS norm
              FROM (SELECT *, CAST(row_number() OVER (PARTITION BY metro_area
                                   ORDER BY round(popularity_score, 9) DESC, business_id) AS INTEGER) AS position
                    FROM scores)
              WHERE position <= 50 WINDOW m AS (PARTITION BY metro_area))""", "scores"),
    "metros": sql("SELECT DISTINCT metro_area FROM scores", "scores"),
    "cities": sql("SELECT DISTINCT city FROM scores", "scores"),
    "in_city": sql(f"SELECT {_SCORE_ROW} FROM scores WHERE city = '{CITY}'", "scores"),
    "businesses_by_cuisine": sql(
        f"SELECT {_SCORE_ROW} FROM scores WHERE lower(categories) LIKE lower('%{CUISINE}%')", "scores"),
    "cuisine_tags_by_metro": sql(f"""
        SELECT DISTINCT metro_area, cuisine
        FROM (SELECT metro_area, trim(unnest(string_split(categories, ','))) AS cuisine FROM scores)
        WHERE lower(cuisine) IN ({_texts(CUISINE_TAGS)})""", "scores"),
    "metro_summary": sql(f"""
        SELECT g.metro_area, neighborhoods, coalesce(restaurants, 0) AS restaurants, {_r('mean_rating')}
        FROM (SELECT metro_area, count(*) AS neighborhoods FROM grid GROUP BY metro_area) g
        LEFT JOIN (SELECT metro_area, count(*) AS restaurants, avg(avg_rating) AS mean_rating FROM scores
                   WHERE lower(categories) LIKE lower('%{CUISINE}%') GROUP BY metro_area) s
          ON s.metro_area = g.metro_area""", "grid"),
    "display_table": sql(f"""
        SELECT name AS "Name", categories AS "Cuisine", round(avg_rating, 6) AS "Avg Rating",
               review_count AS "Reviews", round(popularity_score, 6) AS "Score"
        FROM scores WHERE metro_area = '{METRO}'""", "scores"),
    "business_profiles": sql(f"SELECT {_PROFILE_ROW} FROM profile", "profile"),
    "profiles_with_fallback": sql(f"""
        SELECT {_PROFILE_ROW} FROM profile WHERE metro_area NOT IN ({_texts(UNPROFILED)})
        UNION ALL
        SELECT {_PROFILE_ROW}
        FROM (SELECT *, trim(categories) || ' ' || trim(categories) || ' ' || trim(categories) AS profile_text FROM scores)
        WHERE metro_area IN ({_texts(UNPROFILED)})""", "profile"),
    "sanitized_profiles": sql(
        "SELECT business_id, CAST(review_count AS INTEGER) AS review_count, "
        + ", ".join(_single_line(c) for c in ("name", "metro_area", "city", "profile_text"))
        + ", " + _r("latitude", "longitude", "avg_rating", "popularity_score") + " FROM profile", "profile"),
    "tfidf_vocabulary": sql("""
        SELECT metro_area, doc_count, count(*) AS terms, CAST(sum(corpus_count) AS BIGINT) AS corpus_count,
               round(max(idf), 6) AS idf, min(term) AS first_term, max(term) AS last_term
        FROM vocabulary GROUP BY metro_area, doc_count""", "vocabulary"),
    "tfidf_index": sql("""
        SELECT metro_area, business_id, count(*) AS terms, round(sum(weight), 6) AS weight_sum,
               round(max(weight), 6) AS heaviest, min(term) AS first_term, max(term) AS last_term
        FROM weights GROUP BY metro_area, business_id""", "weights"),
    "tfidf_weights": sql(
        "SELECT metro_area, business_id, term, " + _r("weight") + " FROM weights SEMI JOIN question_term USING (metro_area, term)",
        "weights", "question_term"),
    "text_search": sql(
        "SELECT query_id, business_id, name, metro_area, city, review_count, position, "
        + _r("latitude", "longitude", "avg_rating", "popularity_score", "match_score", "final_score") + " FROM found",
        "found"),
    "search_cards": sql(f"""
        SELECT query_id, position, name, city, review_count, {_full_stars('avg_rating')} AS full_stars,
               5 - {_full_stars('avg_rating')} AS empty_stars,
               least(CAST(trunc(least(final_score, 1) * 100) AS INTEGER), 100) AS match_pct
        FROM found""", "found"),
    "recommendations_for_user": sql(
        "SELECT user_id, requested_metro, city_filtered, rank, business_id, name, city, metro_area, categories,"
        " review_count, " + _r("predicted_rating", "avg_rating", "latitude", "longitude") + " FROM shown", "shown"),
    "recommendation_details": sql(
        "SELECT r.business_id, user_id, rank, name, city, review_count, " + _r("predicted_rating", "avg_rating")
        + " FROM recommendation r LEFT JOIN scores s ON s.business_id = r.business_id", "recommendation", "scores"),
    "recommendation_pins": sql(
        f"SELECT user_id, rank, name, categories, review_count, {_full_stars('avg_rating')} AS full_stars, "
        + _r("latitude", "longitude", "avg_rating", "predicted_rating") + " FROM shown", "shown"),
    "card_fields": sql(f"""
        SELECT user_id, rank, name, categories, city, review_count, {_full_stars('avg_rating')} AS full_stars,
               5 - {_full_stars('avg_rating')} AS empty_stars, round(least(predicted_rating, 5), 6) AS predicted,
               least(CAST(trunc(least(predicted_rating, 5) / 5 * 100) AS INTEGER), 100) AS match_pct
        FROM shown""", "shown"),
    "taste_matches": sql("SELECT user_id, matches, " + _r("avg_pred") + " FROM taste", "taste"),
    "proxy_user": sql(
        "SELECT user_id, matches, " + _r("avg_pred")
        + " FROM taste ORDER BY matches DESC, round(taste.avg_pred, 9) DESC, user_id LIMIT 1", "taste"),
    "predicted_precision_at_k": sql("SELECT " + _r("precision_at_k") + " FROM precision_at", "precision_at"),
    "rating_index": sql("""
        SELECT 'user' AS kind, user_id AS id,
               CAST(row_number() OVER (ORDER BY count(*) DESC, user_id) - 1 AS INTEGER) AS idx
        FROM rating GROUP BY user_id
        UNION ALL
        SELECT 'business', business_id, CAST(row_number() OVER (ORDER BY count(*) DESC, business_id) - 1 AS INTEGER)
        FROM rating GROUP BY business_id""", "rating"),
    "matrix_size": sql(
        "SELECT count(*) AS ratings, count(DISTINCT user_id) AS users, count(DISTINCT business_id) AS businesses FROM rating",
        "rating"),
    "als_top_n": sql("""
        SELECT user_id, CAST(rank AS INTEGER) AS rank, true AS is_known, true AS in_order
        FROM (SELECT DISTINCT user_id FROM train),
             (SELECT unnest(range(1, 1 + least(10, count(DISTINCT business_id)))) AS rank FROM train)""", "train"),
    "als_rmse": sql("""
        SELECT count(*) AS scored, true AS rmse_in_bounds
        FROM (SELECT * FROM rating ANTI JOIN train USING (review_id))
        SEMI JOIN train USING (user_id) WHERE business_id IN (SELECT business_id FROM train)""", "train"),
    "als_rank_sweep": "SELECT CAST(rank AS INTEGER) AS rank, true AS rmse_in_bounds, true AS one_best FROM (VALUES (5), (10), (20)) AS r(rank)",
    "als_grid_search": """
        SELECT CAST(rank AS INTEGER) AS rank, CAST(reg_param AS DOUBLE) AS reg_param, true AS rmse_in_bounds, true AS one_best
        FROM (VALUES (10), (20)) AS r(rank), (VALUES (0.01e0), (0.1e0)) AS p(reg_param)""",
    "als_requests": sql(f"""
        SELECT user_id, '{METRO}' AS metro_area, CAST(rank AS INTEGER) AS rank, true AS is_there, true AS in_order
        FROM (SELECT DISTINCT user_id FROM train),
             (SELECT unnest(range(1, 1 + least(10, count(DISTINCT business_id)))) AS rank
              FROM train SEMI JOIN (SELECT business_id FROM scores WHERE metro_area = '{METRO}') USING (business_id))""",
        "train", "scores"),
    "als_served": sql("""
        SELECT DISTINCT user_id, true AS some_shown, true AS fits, true AS rated, true AS cards_right
        FROM train SEMI JOIN (SELECT DISTINCT user_id FROM recommendation) USING (user_id)""", "train", "recommendation"),
    "als_exact_top_n": sql("""
        SELECT user_id, CAST(rank AS INTEGER) AS rank, true AS agrees
        FROM (SELECT DISTINCT user_id FROM train),
             (SELECT unnest(range(1, 1 + least(10, count(DISTINCT business_id)))) AS rank FROM train)""", "train"),
    "als_in_slices": sql("""
        SELECT count(*) AS scored, true AS as_the_library
        FROM (SELECT * FROM rating ANTI JOIN train USING (review_id))
        SEMI JOIN train USING (user_id) WHERE business_id IN (SELECT business_id FROM train)""", "train"),
    "flat_factors": sql(f"""
        SELECT 'user' AS kind, id, {_rounded("x", "factor")} FROM flat_user_{FLAT_ROUNDS}
        UNION ALL SELECT 'business', id, {_rounded("x", "factor")} FROM flat_business_{FLAT_ROUNDS}""",
        f"flat_user_{FLAT_ROUNDS}", f"flat_business_{FLAT_ROUNDS}"),
    "flat_predictions": sql("SELECT review_id, " + _r("prediction") + " FROM flat_prediction", "flat_prediction"),
    "flat_rmse": sql(
        f"SELECT {_rounded('sqrt(avg((CAST(stars AS DOUBLE) - prediction) ** 2))', 'rmse')} FROM flat_prediction", "flat_prediction"),
    "flat_sweep": sql(
        "SELECT reg_param, " + _r("rmse") + ", row_number() OVER (ORDER BY flat_error.rmse, reg_param) = 1 AS is_best FROM flat_error", "flat_error"),
    "flat_top_n": sql(f"""
        SELECT u.id AS user_id, b.rank, {_rounded("u.x * b.x", "predicted_rating")}
        FROM flat_user_{FLAT_ROUNDS} u,
             (SELECT x, CAST(row_number() OVER (ORDER BY x DESC) AS INTEGER) AS rank FROM flat_business_{FLAT_ROUNDS}) b
        WHERE b.rank <= 10""", f"flat_user_{FLAT_ROUNDS}", f"flat_business_{FLAT_ROUNDS}"),
    "observed_write": sql("""
        SELECT (SELECT count(*) FROM review) AS scanned, (SELECT count(*) FROM review WHERE text IS NULL) AS without_text,
               count(*) AS written, CAST(0 AS BIGINT) AS nulls, count(*) FILTER (stars >= 4) AS good,
               CAST(sum(stars) AS DOUBLE) AS stars, max(date) AS last_date
        FROM clean_review""", "clean_review"),
    "nearest_centres": sql(f"""
        SELECT metro_area, grid_cell, place, round(km, 6) AS distance_km, CAST(rank AS INTEGER) AS rank
        FROM (SELECT metro_area, grid_cell, c.city_key AS place, km,
                     row_number() OVER (PARTITION BY metro_area, grid_cell ORDER BY round(km, 9), c.city_key) AS rank
              FROM grid g, city_anchor c, LATERAL (SELECT {_km('g.center_lat', 'g.center_lng', 'c.center_lat', 'c.center_lng')} AS km))
        WHERE rank <= 2""", "grid", "city_anchor"),
    "sketched_metros": sql("""
        SELECT metro_area, count(DISTINCT user_id) AS users, count(*) AS reviews,
               true AS hll_within, true AS theta_within, true AS all_rows, true AS median_within
        FROM enriched GROUP BY metro_area""", "enriched"),
    "users_shared_with_metro": sql(f"""
        SELECT metro_area, count(*) FILTER (user_id IN (SELECT user_id FROM enriched WHERE metro_area = '{METRO}')) AS shared_users,
               true AS shared_within, true AS either_within
        FROM (SELECT DISTINCT metro_area, user_id FROM enriched) GROUP BY metro_area""", "enriched"),
    "incremental_scores": _SCORES,
    "reviews_through_json": sql(f"""
        SELECT metro_area, count(*) AS reviews,
               CAST(sum(CASE WHEN metro_area = '{METRO}' THEN 5 ELSE stars END) AS BIGINT) AS stars, count(text) AS texts,
               min(md5(text)) AS first_text, max(date) AS last_date, count(DISTINCT user_id) AS users
        FROM review JOIN (SELECT business_id, metro_area FROM venue) USING (business_id)
        WHERE NOT suffix(review_id, '{DAMAGED}') GROUP BY metro_area""", "review", "venue"),
    "rejected_lines": sql(f"SELECT review_id, false AS is_closed FROM review WHERE suffix(review_id, '{DAMAGED}')", "review"),
    # a profile is the categories, three times, and up to 20 digests of 32 characters, all with a blank between them
    "batch_tables": sql(f"""
        SELECT 'reviews_enriched' AS table_name, count(*) AS row_count, count(DISTINCT metro_area) AS metros, {_rounded("sum(recency_weight)", "figure")}
        FROM enriched
        UNION ALL SELECT 'business_scores', count(*), count(DISTINCT metro_area), round(sum(popularity_score), 6) FROM scores
        UNION ALL SELECT 'grid_aggregates', count(*), count(DISTINCT metro_area), round(sum(avg_popularity), 6) FROM grid
        UNION ALL SELECT 'business_profiles', count(*), count(DISTINCT metro_area),
                         CAST(sum(3 * length(trim(categories)) + 2 + least(review_count, 20) * 33) AS DOUBLE) FROM scores""",
        "enriched", "scores", "grid"),
    "venues_of_city": sql(f"SELECT {_SCORE_ROW} FROM scores WHERE city = '{CITY}'", "scores"),
    "venues_by_cuisine": sql(
        f"SELECT {_SCORE_ROW} FROM scores WHERE lower(categories) LIKE lower('%{CUISINE}%')", "scores"),
    "users_matching_taste": sql("SELECT user_id, matches, " + _r("avg_pred") + " FROM taste", "taste"),
    "als_status": "SELECT metric, true AS in_bounds, true AS status_agrees FROM (VALUES ('rmse'), ('precision_at_k'), ('weighted_f1')) AS m(metric)",
    "sentiment_classifier_metrics": sql(
        "SELECT CAST(sum(held_out) AS BIGINT) AS held_out, true AS accuracy_in_bounds, true AS f1_in_bounds FROM held", "held"),
    "sentiment_classifier_confusion": sql("SELECT label AS actual, held_out FROM held", "held"),
    "rmse_of_predictions": sql(
        "SELECT " + _r("rmse") + ", CASE WHEN rmse.rmse < 1.5 THEN 'PASS' ELSE 'FAIL' END AS status FROM rmse", "rmse"),
    "classification_metrics": sql(
        "SELECT " + _r("accuracy", "weighted_f1")
        + ", CASE WHEN f1.weighted_f1 >= 0.8 THEN 'PASS' ELSE 'FAIL' END AS status FROM f1", "f1"),
    "confusion_matrix": sql("""
        SELECT label AS actual, count(*) FILTER (prediction = 0) AS predicted_0,
               count(*) FILTER (prediction = 1) AS predicted_1
        FROM judged GROUP BY label""", "judged"),
    "term_classifier_scores": sql(
        "SELECT review_id, label, " + _r("probability") + ", CAST(prediction AS DOUBLE) AS prediction FROM term_verdict", "term_verdict"),
    "term_classifier_metrics": sql("""
        SELECT round(accuracy, 6) AS accuracy, round(weighted_f1, 6) AS weighted_f1, CASE WHEN weighted_f1 >= 0.8 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT sum(hits) / sum(actual) AS accuracy, sum(2 * hits / (actual + guessed) * actual) / sum(actual) AS weighted_f1
              FROM term_per_label)""", "term_per_label"),
    "term_classifier_confusion": sql("""
        SELECT label AS actual, count(*) FILTER (prediction = 0) AS predicted_0, count(*) FILTER (prediction = 1) AS predicted_1
        FROM term_verdict GROUP BY label""", "term_verdict"),
    "eval_status": sql("""
        SELECT 'rmse' AS metric, round(rmse, 6) AS value, CASE WHEN rmse < 1.5 THEN 'PASS' ELSE 'FAIL' END AS status FROM rmse
        UNION ALL
        SELECT 'weighted_f1', round(weighted_f1, 6), CASE WHEN weighted_f1 >= 0.8 THEN 'PASS' ELSE 'FAIL' END FROM f1
        UNION ALL
        SELECT 'precision_at_k', round(precision_at_k, 6), CASE WHEN precision_at_k >= 0.5 THEN 'PASS' ELSE 'FAIL' END
        FROM precision_at""", "rmse", "f1", "precision_at"),
    "hash_split": sql(
        f"SELECT review_id, substring(md5('42:' || review_id), 1, 8) < '{SPLIT_LIMIT}' AS is_train FROM rating", "rating"),
    "stratified_split": sql("""
        SELECT review_id, label,
               row_number() OVER (PARTITION BY label ORDER BY md5('42:' || review_id), review_id)
               <= round(count(*) OVER (PARTITION BY label) * 0.2e0) AS is_test
        FROM (SELECT review_id, CASE WHEN stars >= 4 THEN 1 ELSE 0 END AS label FROM rating WHERE stars <> 3)""", "rating"),
    "capped_sample": sql(
        f"SELECT review_id, stars FROM rating ORDER BY md5('42:' || review_id), review_id LIMIT {SAMPLE}", "rating"),
    "duplicate_keys": sql(
        'SELECT user_id, business_id, count(*) AS "rows" FROM rating GROUP BY ALL HAVING count(*) > 1', "rating"),
    "star_frequency": sql('SELECT stars, count(*) AS "rows" FROM review GROUP BY stars', "review"),
    "city_frequency": sql('SELECT city, count(*) AS "rows" FROM business GROUP BY city', "business"),
    "open_frequency": sql(
        "SELECT CASE is_open WHEN 1 THEN 'Open' ELSE 'Closed' END AS state, count(*) AS \"rows\" FROM business GROUP BY 1",
        "business"),
    "score_histogram": sql("""
        SELECT s.metric, CAST(s.bin AS INTEGER) AS bin, round(low + (high - low) / 20 * s.bin, 6) AS bin_start,
               count(b.bin) AS "rows", round(any_value(mean), 6) AS mean
        FROM (SELECT metric, min(value) AS low, max(value) AS high, avg(value) AS mean, unnest(range(20)) AS bin
              FROM measure WHERE metric IN ('avg_rating', 'popularity_score') GROUP BY metric) s
        LEFT JOIN (SELECT metric,
                          least(floor((value - min(value) OVER m) / greatest(max(value) OVER m - min(value) OVER m, 1e-12) * 20), 19) AS bin
                   FROM measure WINDOW m AS (PARTITION BY metric)) b
          ON b.metric = s.metric AND b.bin = s.bin
        GROUP BY s.metric, s.bin, low, high""", "measure"),
    "score_summary": sql(
        "SELECT metric, count(*) AS count, "
        + ", ".join(
            f"CAST(round_even(CAST({figure} AS DECIMAL(38,12)), 3) AS DOUBLE) AS {name}" for name, figure in {
                "mean": "avg(value)", "std": "stddev_samp(value)", "min": "min(value)",
                "p25": "quantile_cont(value, 0.25)", "p50": "quantile_cont(value, 0.5)",
                "p75": "quantile_cont(value, 0.75)", "max": "max(value)",
            }.items())
        + " FROM measure GROUP BY metric", "measure"),
    "rank_shift": sql(
        "SELECT business_id, name, review_count, rank_raw, rank_pop, rank_pop - rank_raw AS rank_shift, "
        + _r("avg_rating", "popularity_score") + " FROM places", "places"),
    "rank_movers": sql(
        "SELECT business_id, name, review_count, rank_raw, rank_pop, rank_shift, direction, "
        + _r("avg_rating", "popularity_score") + """
        FROM (SELECT * FROM (SELECT *, rank_pop - rank_raw AS rank_shift, 'up' AS direction FROM places
                             ORDER BY rank_shift, business_id LIMIT 10)
              UNION ALL
              SELECT * FROM (SELECT *, rank_pop - rank_raw AS rank_shift, 'down' AS direction FROM places
                             ORDER BY rank_shift DESC, business_id LIMIT 10))""", "places"),
    "top10_by_city": sql(f"""
        SELECT city, position, business_id, name, {_r('popularity_score')},
               {_band('norm', '0.7', '0.4', ('#c62828', '#e65100', '#2e7d32'))} AS colour
        FROM (SELECT *, (popularity_score - min(popularity_score) OVER c)
                        / greatest(max(popularity_score) OVER c - min(popularity_score) OVER c, 1e-9) AS norm
              FROM (SELECT *, CAST(row_number() OVER (PARTITION BY city
                                   ORDER BY round(popularity_score, 9) DESC, business_id) AS INTEGER) AS position
                    FROM scores)
              WHERE position <= 10 WINDOW c AS (PARTITION BY city))""", "scores"),
}

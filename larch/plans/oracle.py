"""DuckDB SQL for the registered queries: an independent statement of the
same result over the same Parquet views."""

from __future__ import annotations

LABELLED = ("(SELECT p_partkey, CASE WHEN p_size <= 25 THEN p_name END AS label "
            "FROM part)")
PRESENT = "label IS NOT NULL AND label <> ''"


def _csv_field(expr: str) -> str:
    return (f"coalesce(CASE WHEN regexp_matches({expr}, '[,\"\\r\\n]') "
            f"THEN '\"' || replace({expr}, '\"', '\"\"') || '\"' ELSE {expr} END, '')")


def _period(year: int) -> str:
    return (f"SELECT c_name FROM customer WHERE c_custkey IN ("
            f"SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '{year}-01-01' "
            f"AND o_orderdate < TIMESTAMP '{year + 1}-01-01')")


RATINGS = ("(SELECT o_custkey AS userId, "
           "CAST(substr(p_brand, 7) AS BIGINT) AS itemId, "
           "CAST(ceil(avg(l_quantity) / 10) AS DOUBLE) AS rating, count(*) AS n_lines "
           "FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
           "JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)")

RATING_LINES = ("(SELECT CAST(userId AS VARCHAR) || '::' || CAST(itemId AS VARCHAR) || '::' "
                "|| CAST(CAST(rating AS INTEGER) AS VARCHAR) || '::' || CAST(n_lines AS VARCHAR) "
                f"AS value FROM {RATINGS} r)")

BUCKET = ("(('0x' || substr(md5('42:' || CAST(userId AS VARCHAR) || ':' || "
          "CAST(itemId AS VARCHAR)), 1, 8))::BIGINT % 100)")

FOLDED = (f"(SELECT userId, itemId, rating, CASE WHEN {BUCKET} < 80 THEN 'train' "
          f"ELSE 'test' END AS fold FROM {RATINGS} r)")
TRAIN = f"(SELECT userId, itemId, rating FROM {FOLDED} f WHERE fold = 'train')"
TEST = f"(SELECT userId, itemId, rating FROM {FOLDED} f WHERE fold = 'test')"



# --- baskets -------------------------------------------------------------

def _basket_items(attr: str) -> str:
    return (f"(SELECT DISTINCT l_orderkey AS id, {attr} AS item "
            f"FROM lineitem JOIN part ON l_partkey = p_partkey)")


def _itemset_ctes(attr: str, support: float, max_size: int) -> list[str]:
    """CTEs ``b`` (basket, item), ``m`` (N and the minimum count) and
    ``f1..fk``: every itemset of size k with its frequency, enumerated by a
    k-way self-join on the basket with items in increasing order."""
    ctes = [f"b AS {_basket_items(attr)}",
            f"m AS (SELECT count(DISTINCT id) AS n, "
            f"ceil(CAST({support} AS DOUBLE) * count(DISTINCT id)) AS minc FROM b)"]
    for k in range(1, max_size + 1):
        cols = ", ".join(f"b{j}.item AS i{j}" for j in range(1, k + 1))
        frm = "b b1" + "".join(
            f" JOIN b b{j} ON b{j}.id = b1.id AND b{j}.item > b{j - 1}.item"
            for j in range(2, k + 1))
        groups = ", ".join(str(j) for j in range(1, k + 1))
        ctes.append(f"f{k} AS (SELECT {cols}, count(*) AS freq FROM {frm} "
                    f"GROUP BY {groups} HAVING count(*) >= (SELECT minc FROM m))")
    return ctes


def _joined_cols(alias: str, idx: list[int]) -> str:
    return "concat_ws(',', " + ", ".join(f"{alias}.i{j}" for j in idx) + ")"


def itemsets_sql(attr: str, support: float, max_size: int) -> str:
    ctes = _itemset_ctes(attr, support, max_size)
    parts = [f"SELECT {_joined_cols(f'f{k}', list(range(1, k + 1)))} AS items, "
             f"CAST({k} AS INTEGER) AS size, freq FROM f{k}"
             for k in range(1, max_size + 1)]
    every = "WITH " + ", ".join(ctes) + " SELECT * FROM (" + " UNION ALL ".join(parts) + ") s"
    # The largest size enumerated must be empty, unless it is the vocabulary.
    return every + (f" WHERE (SELECT CASE WHEN (SELECT count(*) FROM f{max_size}) = 0 "
                    f"OR (SELECT count(DISTINCT item) FROM b) <= {max_size} THEN true "
                    "ELSE error('itemset oracle: larger sets may be frequent') END)")


def _rules_cte(max_size: int, confidence: float) -> str:
    """CTE ``r``: rules with one consequent from every itemset of size >= 2."""
    parts = []
    for k in range(2, max_size + 1):
        for j in range(1, k + 1):
            rest = [x for x in range(1, k + 1) if x != j]
            on = " AND ".join(f"a.i{pos} = u.i{x}" for pos, x in enumerate(rest, start=1))
            parts.append(
                f"SELECT {_joined_cols('u', rest)} AS antecedent, u.i{j} AS consequent, "
                f"u.freq / a.freq AS confidence FROM f{k} u JOIN f{k - 1} a ON {on}")
    return ("r AS (SELECT * FROM (" + " UNION ALL ".join(parts) + ") x "
            f"WHERE confidence >= CAST({confidence} AS DOUBLE))")


def rules_sql(attr: str, support: float, confidence: float, max_size: int) -> str:
    ctes = _itemset_ctes(attr, support, max_size) + [_rules_cte(max_size, confidence)]
    return ("WITH " + ", ".join(ctes) +
            " SELECT antecedent, consequent, round(confidence, 6) AS confidence FROM r")


def interest_sql(attr: str, support: float, confidence: float, max_size: int) -> str:
    ctes = _itemset_ctes(attr, support, max_size) + [_rules_cte(max_size, confidence)]
    return ("WITH " + ", ".join(ctes) +
            " SELECT r.antecedent, r.consequent, round(r.confidence, 6) AS confidence, "
            "s.i1 AS items, s.freq, round(abs(r.confidence - s.freq / m.n), 6) AS interest "
            "FROM r JOIN f1 s ON s.i1 = r.consequent, m")


BASKETS = ("SELECT row_number() OVER (ORDER BY id) - 1 AS id, CAST(id AS VARCHAR) AS name, "
           "string_agg(item, ',' ORDER BY item) AS items "
           f"FROM {_basket_items('p_type')} b GROUP BY id")



# --- membership and k-means ---------------------------------------------

NATION_PARTS = ("(SELECT DISTINCT c_nationkey AS entity, l_partkey AS feature FROM lineitem "
                "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)")
CUSTOMER_BRANDS = ("(SELECT DISTINCT o_custkey AS entity, p_brand AS feature FROM lineitem "
                   "JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)")

MEMBERSHIP_SETS = (f"WITH c AS {NATION_PARTS} SELECT entity, count(*) AS n_features, "
                   "(SELECT count(DISTINCT feature) FROM c) - count(*) AS n_absent "
                   "FROM c GROUP BY entity")

MEMBERSHIP_LOOKUP = (f"WITH c AS {NATION_PARTS} SELECT p.entity, p.feature, c.entity IS NOT NULL AS present "
                     "FROM (SELECT p_partkey % 30 AS entity, p_partkey AS feature FROM part) p "
                     "LEFT JOIN c ON c.entity = p.entity AND c.feature = p.feature")

PAIR_DISTANCES = (f"WITH c AS {NATION_PARTS}, p AS (SELECT n_nationkey AS a, n_nationkey + 1 AS b FROM nation) "
                  "SELECT p.a, p.b, (SELECT count(*) FROM c WHERE c.entity = p.a) "
                  "+ (SELECT count(*) FROM c WHERE c.entity = p.b) - 2 * (SELECT count(*) FROM c x JOIN c y "
                  "ON x.feature = y.feature WHERE x.entity = p.a AND y.entity = p.b) AS distance FROM p")


BUILDING = "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'"


def _init_cte(k: int, seed: int, candidates: str | None = None) -> str:
    where = f" WHERE entity IN ({candidates})" if candidates else ""
    key = f"md5('{seed}:' || CAST(entity AS VARCHAR))"
    return (f"a0 AS (SELECT CAST(row_number() OVER (ORDER BY {key}, entity) - 1 AS INTEGER) AS cluster, "
            f"entity FROM (SELECT DISTINCT entity FROM c{where}) e ORDER BY {key}, entity LIMIT {k})")


def _stats_ctes(r: int) -> list[str]:
    """Weights ``w{r}`` (feature, cluster, w) and sizes ``s{r}`` (cluster,
    m, sq) of assignment ``a{r}``; a cluster without members keeps the
    statistics of round r-1."""
    keep_w = keep_s = ""
    if r > 0:
        keep_w = (f" UNION ALL SELECT feature, cluster, w FROM w{r - 1} "
                  f"WHERE cluster NOT IN (SELECT cluster FROM a{r})")
        keep_s = (f" UNION ALL SELECT cluster, m FROM m{r - 1} "
                  f"WHERE cluster NOT IN (SELECT cluster FROM a{r})")
    return [
        f"w{r} AS (SELECT feature, cluster, count(*) AS w FROM c JOIN a{r} USING (entity) "
        f"GROUP BY feature, cluster{keep_w})",
        f"m{r} AS (SELECT cluster, count(*) AS m FROM a{r} GROUP BY cluster{keep_s})",
        f"s{r} AS (SELECT m{r}.cluster, m{r}.m, coalesce(q.sq, 0) AS sq FROM m{r} LEFT JOIN "
        f"(SELECT cluster, sum(w * w) AS sq FROM w{r} GROUP BY cluster) q USING (cluster))",
    ]


def _assign_cte(r: int) -> str:
    """Assignment ``a{r}`` from the statistics of round r-1."""
    p = r - 1
    dist = ("CAST(x.nx AS DOUBLE) - (CAST(2 AS DOUBLE) * CAST(coalesce(t.dot, 0) AS DOUBLE)) "
            "/ CAST(s.m AS DOUBLE) + CAST(s.sq AS DOUBLE) / (CAST(s.m AS DOUBLE) * CAST(s.m AS DOUBLE))")
    return (f"a{r} AS (SELECT entity, cluster FROM ("
            f"SELECT x.entity, s.cluster, row_number() OVER (PARTITION BY x.entity "
            f"ORDER BY {dist}, s.cluster) AS rk "
            f"FROM nx x CROSS JOIN s{p} s LEFT JOIN "
            f"(SELECT c.entity, w.cluster, sum(w.w) AS dot FROM c JOIN w{p} w USING (feature) "
            f"GROUP BY c.entity, w.cluster) t ON t.entity = x.entity AND t.cluster = s.cluster"
            f") z WHERE rk = 1)")


def kmeans_ctes(rounds: int, k: int = 4, seed: int = 42, candidates: str | None = None) -> list[str]:
    ctes = [f"c AS {CUSTOMER_BRANDS}",
            "nx AS (SELECT entity, count(*) AS nx FROM c GROUP BY entity)",
            _init_cte(k, seed, candidates)]
    ctes += _stats_ctes(0)
    for r in range(1, rounds + 1):
        ctes.append(_assign_cte(r))
        if r < rounds:
            ctes += _stats_ctes(r)
    return ctes


SEEDED_CENTROIDS = "WITH " + ", ".join(kmeans_ctes(0)[:3]) + " SELECT cluster, entity FROM a0"
LISTED_CENTROIDS = ("WITH " + ", ".join(kmeans_ctes(0, candidates=BUILDING)[:3]) +
                    " SELECT cluster, entity FROM a0")


def _nearest(candidates: str | None = None) -> str:
    return ("WITH " + ", ".join(kmeans_ctes(1, candidates=candidates)) +
            " SELECT i.entity AS centroid, a1.entity FROM a1 JOIN a0 i USING (cluster)")


# Rounds unrolled for the converged oracle.  Lloyd's assignments are a fixed
# point once stable, so extra rounds do not change the answer; the query fails
# unless its last two rounds agree.
CONVERGED_ROUNDS = 40
_LAST = f"a{CONVERGED_ROUNDS}"
KMEANS_CONVERGED = (
    "WITH " + ", ".join(kmeans_ctes(CONVERGED_ROUNDS)) +
    f", same AS (SELECT count(*) AS n FROM {_LAST} x JOIN a{CONVERGED_ROUNDS - 1} y USING (entity) "
    "WHERE x.cluster <> y.cluster) "
    f"SELECT i.entity AS centroid, z.entity FROM {_LAST} z JOIN a0 i USING (cluster) "
    "WHERE (SELECT CASE WHEN n = 0 THEN true ELSE error('k-means oracle: not converged') END FROM same)")

VALUE_COUNTS = (f"SELECT label, count(*) AS n FROM {LABELLED} t WHERE {PRESENT} "
                f"GROUP BY label ORDER BY label")

# ALS scores the test rows whose user and item it was fitted on.
#: Orders as sets of parts, the orders with an equal set, and pairs that differ in one
#: part at most (such sets share a part).
NEAR = """c AS (SELECT DISTINCT l_orderkey AS e, l_partkey AS f FROM lineitem),
n AS (SELECT e, count(*) AS n, list_sort(list(f)) AS fs FROM c GROUP BY e),
k AS (SELECT e, min(e) OVER (PARTITION BY fs) AS class FROM n),
o AS (SELECT x.e AS a, y.e AS b, count(*) AS k FROM c x JOIN c y ON x.f = y.f AND x.e < y.e GROUP BY 1, 2),
p AS (SELECT a, b, x.n + y.n - 2 * o.k AS distance FROM o JOIN n x ON x.e = a JOIN n y ON y.e = b
      WHERE x.n + y.n - 2 * o.k <= 1)"""

#: Rows in the test fold and rows that ALS scores.  Its factors, and so its error,
#: have no SQL: the tests compare the error with the normal equations.
ALS_SCORED = (f"SELECT (SELECT count(*) FROM {TEST} t) AS n_test, count(*) AS n_scored "
              f"FROM {TEST} t WHERE userId IN (SELECT userId FROM {TRAIN} u) "
              f"AND itemId IN (SELECT itemId FROM {TRAIN} i)")

EVENTS = """(SELECT event_id, ts, CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, event_type,
CAST(round(value * 100) AS BIGINT) AS cents FROM events)"""
BY_USER = "OVER (PARTITION BY user_id ORDER BY ts, event_id)"

ORACLE: dict[str, str] = {
    "event_asof": (f"SELECT p.event_id, p.user_id, v.event_id AS view_id, v.cents AS view_cents "
                   f"FROM (SELECT * FROM {EVENTS} e WHERE event_type = 'purchase') p ASOF LEFT JOIN "
                   f"(SELECT * FROM {EVENTS} e WHERE event_type = 'view') v "
                   "ON p.user_id = v.user_id AND p.ts >= v.ts"),
    "event_windows": (f"SELECT event_id, user_id, row_number() {BY_USER} AS nth, "
                      f"CAST(sum(cents) {BY_USER} AS BIGINT) AS total, lag(event_type) {BY_USER} AS last_type, "
                      f"lead(event_id) {BY_USER} AS next_id FROM {EVENTS} e"),
    "event_sessions": (f"SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS n, "
                       "min(event_id) AS first_id, CAST(sum(cents) AS BIGINT) AS cents FROM (SELECT *, "
                       f"sum(CASE WHEN late THEN 1 ELSE 0 END) {BY_USER} AS session FROM (SELECT *, "
                       f"coalesce(ts - lag(ts) {BY_USER} > INTERVAL 6 HOUR, true) AS late FROM {EVENTS} e) l) s "
                       "GROUP BY 1, 2"),
    "order_sketches": ("SELECT o_orderpriority, count(DISTINCT o_custkey) AS n_customers, "
                       "true AS distinct_close, true AS median_close FROM orders GROUP BY 1"),
    "order_rollup": ("SELECT o_orderstatus, o_orderpriority, "
                     "CAST(grouping(o_orderstatus, o_orderpriority) AS BIGINT) AS grouping, count(*) AS n, "
                     "max(o_custkey) AS last_customer FROM orders GROUP BY GROUPING SETS "
                     "((o_orderstatus, o_orderpriority), (o_orderstatus), (o_orderpriority), ())"),
    "row_count": f"SELECT count(*) AS n FROM {LABELLED} t",
    "present_count": f"SELECT count(*) AS n FROM {LABELLED} t WHERE {PRESENT}",
    "distinct_values": f"SELECT DISTINCT label FROM {LABELLED} t WHERE {PRESENT} ORDER BY label",
    "value_counts": VALUE_COUNTS,
    "top_values": (f"SELECT label, count(*) AS n FROM {LABELLED} t WHERE {PRESENT} "
                   f"GROUP BY label ORDER BY n DESC, label ASC LIMIT 10"),
    "common_values": (f"SELECT c_name FROM ({_period(1995)}) a "
                      f"WHERE c_name IS NOT NULL AND c_name <> '' "
                      f"INTERSECT SELECT c_name FROM ({_period(1996)}) b "
                      f"WHERE c_name IS NOT NULL AND c_name <> '' ORDER BY c_name"),
    "csv_lines": (f"SELECT {_csv_field('label')} || ',' || CAST(n AS VARCHAR) AS line "
                  f"FROM ({VALUE_COUNTS}) v"),
    "parse_ratings": ("SELECT CAST(p[1] AS BIGINT) AS userId, CAST(p[2] AS BIGINT) AS itemId, "
                      "CAST(p[3] AS DOUBLE) AS rating FROM (SELECT string_split(value, '::') AS p "
                      f"FROM {RATING_LINES} l) s"),
    # Every fifth part's record has a field too many or too few.
    "csv_scan": ("SELECT p_brand, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS size, "
                 "max(p_name) AS last_name FROM part WHERE p_partkey % 5 <> 0 GROUP BY p_brand"),
    "csv_account": ("SELECT count(*) AS n_records, count(*) FILTER (p_partkey % 5 <> 0) AS n_kept, "
                    "count(*) FILTER (p_partkey % 5 = 0) AS n_dropped FROM part"),
    # An empty field reads as NULL.
    "csv_quoted_records": ("SELECT doc_id, nullif(lang, '') AS lang, CAST(length(t) AS BIGINT) AS n_chars, "
                           "md5(t) AS text_md5 FROM (SELECT *, nullif(text, '') AS t FROM documents) d"),
    "file_baskets": BASKETS,
    "near_entities": (f"WITH {NEAR} SELECT k.e AS entity, class, count(z.e) AS n_near FROM k LEFT JOIN "
                      "(SELECT a AS e FROM p UNION ALL SELECT b FROM p) z ON z.e = k.e GROUP BY 1, 2"),
    "near_pairs": (f"WITH {NEAR} SELECT a, b, distance FROM p "
                   "JOIN k x ON x.e = a AND x.class = a JOIN k y ON y.e = b AND y.class = b"),
    # DuckDB sums integers as HUGEINT; the key sums fit BIGINT, as in Spark.
    "rating_split": ("SELECT fold, count(*) AS n, CAST(sum(userId) AS BIGINT) AS sum_user, "
                     "CAST(sum(itemId) AS BIGINT) AS sum_item "
                     f"FROM {FOLDED} f GROUP BY fold"),
    "global_mean": f"SELECT avg(rating) AS global_mean FROM {TRAIN} t",
    "global_mean_rmse": ("SELECT count(*) AS n_test, round(sqrt(avg(pow(rating - g.gm, 2))), 6) AS rmse "
                         f"FROM {TEST} t, (SELECT avg(rating) AS gm FROM {TRAIN} t2) g"),
    "means_interaction": (
        "WITH tr AS " + TRAIN + ", "
        "um AS (SELECT userId, avg(rating) AS user_mean FROM tr GROUP BY userId), "
        "im AS (SELECT itemId, avg(rating) AS item_mean FROM tr GROUP BY itemId), "
        "g AS (SELECT avg(rating) AS gm FROM tr) "
        "SELECT tr.userId, tr.itemId, tr.rating, round(user_mean, 6) AS user_mean, "
        "round(item_mean, 6) AS item_mean, "
        "round(tr.rating - (user_mean + item_mean - g.gm), 6) AS user_item_interaction "
        "FROM tr JOIN im ON tr.itemId = im.itemId JOIN um ON tr.userId = um.userId, g "
        "ORDER BY tr.userId, tr.itemId"),
    "baskets": BASKETS,
    "first_baskets": f"SELECT * FROM ({BASKETS}) t ORDER BY id LIMIT 10",
    # Six part types: every subset size up to six is enumerated.
    "frequent_itemsets": itemsets_sql("p_type", 0.05, 6),
    "association_rules": rules_sql("p_type", 0.05, 0.3, 6),
    "rule_interest": interest_sql("p_type", 0.05, 0.3, 6),
    # 25 brands: sizes up to five (none above three is frequent at sf0.01;
    # by downward closure an empty size ends the enumeration).
    "frequent_pairs": itemsets_sql("p_brand", 0.005, 5),
    "membership_sets": MEMBERSHIP_SETS,
    "membership_lookup": MEMBERSHIP_LOOKUP,
    "pair_distances": PAIR_DISTANCES,
    "seeded_centroids": SEEDED_CENTROIDS,
    "listed_centroids": LISTED_CENTROIDS,
    "nearest_centroid": _nearest(),
    "nearest_listed_centroid": _nearest(BUILDING),
    "kmeans_converged": KMEANS_CONVERGED,
}

_SIZE = "len(string_split({}, ','))"
ORACLE |= {
    "first_means": f"SELECT * FROM ({ORACLE['means_interaction']}) t ORDER BY userId, itemId LIMIT 10",
    "first_itemsets": (f"SELECT * FROM ({ORACLE['frequent_itemsets']}) t "
                       "ORDER BY size DESC, freq DESC, replace(items, ',', ' ') LIMIT 10"),
    "first_rules": (f"SELECT * FROM ({ORACLE['association_rules']}) t ORDER BY {_SIZE.format('antecedent')} DESC, "
                    "confidence DESC, replace(antecedent, ',', ' '), consequent LIMIT 10"),
    "first_interest": (f"SELECT * FROM ({ORACLE['rule_interest']}) t ORDER BY {_SIZE.format('antecedent')} DESC, "
                       "interest DESC, replace(antecedent, ',', ' '), consequent LIMIT 10"),
}

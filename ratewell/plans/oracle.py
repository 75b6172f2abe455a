"""The registered queries in plain SQL, written independently of the DataFrame code."""

from __future__ import annotations

RATINGS = """
r AS (
  SELECT o_custkey AS user_id, l_suppkey AS item_id,
         max_by(ceil(l_quantity / 5) / 2, (o_orderdate, l_orderkey, l_linenumber, l_extendedprice)) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_suppkey
)"""

LABELLED = f"""{RATINGS},
s AS (
  SELECT *, CASE WHEN CAST('0x' || substr(md5('42:' || user_id || ':' || item_id), 1, 8) AS BIGINT) % 100 < 80
                 THEN 'train' ELSE 'test' END AS split
  FROM r
),
train AS (SELECT user_id, item_id, rating FROM s WHERE split = 'train'),
test AS (SELECT user_id, item_id, rating FROM s WHERE split = 'test'),
gm AS (SELECT avg(rating) AS m FROM train)"""

TOP = f"""{RATINGS},
kept AS (
  SELECT * FROM r
  WHERE user_id IN (SELECT user_id FROM r GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1000)
    AND item_id IN (SELECT item_id FROM r GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT 80)
)"""


def _neighbors(e: str, o: str) -> str:
    return f"""{LABELLED},
st AS (SELECT {e} AS e, avg(rating) AS a, count(*) AS n FROM train GROUP BY {e}),
dev AS (SELECT t.{e} AS e, t.{o} AS o, t.rating - st.a AS d FROM train t JOIN st ON t.{e} = st.e),
nm AS (SELECT e, sqrt(sum(d * d)) AS g FROM dev GROUP BY e),
pr AS (
  SELECT x.e AS i, y.e AS j, sum(x.d * y.d) AS num
  FROM dev x JOIN dev y ON x.o = y.o AND x.e < y.e
  GROUP BY x.e, y.e HAVING count(*) > 5
),
w AS (
  SELECT i, j, CASE WHEN p.g = 0 OR q.g = 0 OR abs(num / (p.g * q.g)) < 1e-12 THEN 0.0 ELSE num / (p.g * q.g) END AS w
  FROM pr JOIN nm p ON p.e = i JOIN nm q ON q.e = j
),
near AS (
  SELECT e, f, w, row_number() OVER (PARTITION BY e ORDER BY round(w, 9) + 0.0 DESC, f DESC) AS rk
  FROM (SELECT i AS e, j AS f, w FROM w UNION ALL SELECT j, i, w FROM w)
  QUALIFY rk <= 25
)"""


def _stats(e: str) -> str:
    return f"""WITH {LABELLED},
st AS (SELECT {e}, avg(rating) AS a FROM train GROUP BY {e})
SELECT {e}, count(*) AS n, round(any_value(a), 6) AS avg, round(sqrt(sum((rating - a) * (rating - a))), 6) AS sigma
FROM train JOIN st USING ({e}) GROUP BY {e}"""


def _neighbors_query(e: str, o: str) -> str:
    return f"""WITH {_neighbors(e, o)}
SELECT e AS entity, f AS neighbor, round(w, 6) + 0.0 AS weight, CAST(rk AS INTEGER) AS rank FROM near"""


def _predicted(e: str, o: str, fallback: str, source: str) -> str:
    rest = "0.0" if fallback == "zero" else "greatest(0.5, least(5.0, coalesce(st.a, (SELECT m FROM gm))))"
    return f"""{_neighbors(e, o)},
votes AS (
  SELECT q.user_id, q.item_id, sum(near.w * dev.d) AS num, sum(abs(near.w)) AS den
  FROM {source} q JOIN near ON near.e = q.{e} JOIN dev ON dev.e = near.f AND dev.o = q.{o}
  GROUP BY q.user_id, q.item_id
),
pred AS (
  SELECT q.*, CASE WHEN v.den > 0 THEN greatest(0.5, least(5.0, v.num / v.den + st.a)) ELSE {rest} END AS prediction
  FROM {source} q LEFT JOIN votes v USING (user_id, item_id) LEFT JOIN st ON st.e = q.{e}
)"""


def _knn_predict(e: str, o: str, fallback: str) -> str:
    return f"""WITH {_predicted(e, o, fallback, 'test')}
SELECT user_id, item_id, round(prediction, 6) + 0.0 AS prediction FROM pred"""


def _knn_mse(e: str, o: str) -> str:
    return f"""WITH {_predicted(e, o, 'mean', 's')}
SELECT split, count(*) AS n, round(avg((rating - prediction) * (rating - prediction)), 6) AS mse
FROM pred GROUP BY split"""


def _formula(ident: str, position: str | int, table: int) -> str:
    return f"((({ident} * 31 + {position} * 17 + {table} * 13) % 101) - 50) / 100.0"


_BILINEAR = (
    f"{_formula('user_id', 10, 0)} + {_formula('item_id', 10, 1)}"
    + f" + list_sum([({_formula('user_id', 'f', 0)}) * ({_formula('item_id', 'f', 1)}) FOR f IN range(10)])"
)

_PERCEPTRON = f"""{_formula(0, 0, 7)} + list_sum([
    ({_formula('j', 0, 6)}) * greatest(0.0, {_formula('j', 0, 5)}
      + list_sum([({_formula('user_id', 'f', 0)}) * ({_formula('j', 'f', 4)}) FOR f IN range(10)])
      + list_sum([({_formula('item_id', 'f', 1)}) * ({_formula('j', '(f + 10)', 4)}) FOR f IN range(10)]))
    FOR j IN range(10)])"""


def _forward(value: str) -> str:
    return f"WITH {RATINGS} SELECT user_id, item_id, round({value}, 6) + 0.0 AS prediction FROM r"


_MF_SCORED = f"""{LABELLED},
scored AS (
  SELECT user_id, item_id, split, rating - (SELECT m FROM gm) AS y, {_BILINEAR} AS p FROM s
)"""

_CODER = f"""{LABELLED},
unit AS (SELECT unnest(range(700)) AS j),
net AS (
  SELECT t.user_id, j, sum((rating - (SELECT m FROM gm)) * ({_formula('item_id', 'j', 8)})) AS z
  FROM train t, unit GROUP BY t.user_id, j
),
code AS (
  SELECT u.user_id, unit.j, tanh({_formula('unit.j', 0, 11)} + coalesce(net.z, 0)) AS a
  FROM (SELECT DISTINCT user_id FROM s) u CROSS JOIN unit LEFT JOIN net ON net.user_id = u.user_id AND net.j = unit.j
),
coded AS (
  SELECT s.user_id, s.item_id, s.split, any_value(s.rating) - (SELECT m FROM gm) AS y,
         sum(a * ({_formula('s.item_id', 'j', 9)})) + {_formula('s.item_id', 0, 10)} AS p
  FROM s JOIN code USING (user_id) GROUP BY s.user_id, s.item_id, s.split
)"""

_W1, _B1 = _formula("j", "f", 4), f"({_formula('j', 0, 5)} + 3e-5)"


def _network_step(bilinear: bool) -> str:
    """One step of the network models: relu back-propagation summed by parameter."""
    width = 11 if bilinear else 10

    def own(kind: str) -> str:
        return f"{_formula(f'{kind}_id', 'pos', 0 if kind == 'user' else 1)}"

    def rows(kind: str, other: str, shift: int) -> str:
        plain = f"CASE WHEN pos = 10 THEN 1 ELSE {_formula(f'{other}_id', 'pos', 0 if other == 'user' else 1)} END" if bilinear else "0"
        back = f"CASE WHEN pos = 10 THEN 0 ELSE list_sum([back[j + 1] * ({_formula('j', f'(pos + {shift})', 4)}) FOR j IN range(10)]) END"
        return f"""SELECT '{kind}' AS kind, {kind}_id AS idx, pos, sum(e * ({plain}) + {back}) AS g, any_value({own(kind)}) AS v
  FROM b, (SELECT unnest(range({width})) AS pos) GROUP BY {kind}_id, pos"""

    value = _PERCEPTRON.replace("greatest(0.0, ", "greatest(0.0, 3e-5 + ")
    value = f"{_BILINEAR} + {value}" if bilinear else value
    inputs = f"CASE WHEN f < 10 THEN {_formula('user_id', 'f', 0)} ELSE {_formula('item_id', '(f - 10)', 1)} END"
    return f"""WITH {LABELLED},
x AS (
  SELECT user_id, item_id, split, ({value}) - (rating - (SELECT m FROM gm)) AS e,
         [{_B1} + list_sum([({_formula('user_id', 'f', 0)}) * ({_W1}) FOR f IN range(10)])
          + list_sum([({_formula('item_id', 'f', 1)}) * ({_formula('j', '(f + 10)', 4)}) FOR f IN range(10)]) FOR j IN range(10)] AS z
  FROM s
),
b AS (
  SELECT *, [CASE WHEN z[j + 1] > 0 THEN e * ({_formula('j', 0, 6)}) ELSE 0 END FOR j IN range(10)] AS back
  FROM x WHERE split = 'train'
),
l AS (SELECT count(*) * sqrt(avg(e * e) + 1e-8) AS nl FROM b),
unit AS (SELECT unnest(range(10)) AS j),
spot AS (SELECT unnest(range(20)) AS f),
g AS (
  {rows('user', 'item', 0)}
  UNION ALL {rows('item', 'user', 10)}
  UNION ALL SELECT 'net', 0, j * 20 + f, sum(back[j + 1] * ({inputs})), any_value({_W1}) FROM b, unit, spot GROUP BY j, f
  UNION ALL SELECT 'net', 0, 200 + j, sum(back[j + 1]), any_value({_B1}) FROM b, unit GROUP BY j
  UNION ALL SELECT 'net', 0, 210 + j, sum(e * greatest(z[j + 1], 0)), any_value({_formula('j', 0, 6)}) FROM b, unit GROUP BY j
  UNION ALL SELECT 'net', 0, 220, sum(e), any_value({_formula(0, 0, 7)}) FROM b
),
still AS (
  SELECT 'user' AS kind, user_id AS idx, pos, {own('user')} AS v FROM (SELECT DISTINCT user_id FROM s), (SELECT unnest(range({width})) AS pos)
  UNION ALL SELECT 'item', item_id, pos, {own('item')} FROM (SELECT DISTINCT item_id FROM s), (SELECT unnest(range({width})) AS pos)
)
SELECT kind, idx::BIGINT AS idx, pos::INTEGER AS pos, round(v - (g / (SELECT nl FROM l) + 1e-5 * v), 6) + 0.0 AS value FROM g
UNION ALL
SELECT kind, idx::BIGINT, pos::INTEGER, round(v - 1e-5 * v, 6) + 0.0
FROM still WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.kind = still.kind AND g.idx = still.idx AND g.pos = still.pos)"""


_CODER_STEP = f"""WITH {LABELLED},
t AS (SELECT user_id, item_id, rating - (SELECT m FROM gm) AS x FROM train),
unit AS (SELECT unnest(range(700)) AS j),
code AS (
  SELECT user_id, j, tanh({_formula('j', 0, 11)} + sum(x * ({_formula('item_id', 'j', 8)}))) AS a FROM t, unit GROUP BY user_id, j
),
e AS (
  SELECT user_id, item_id, any_value(x) AS x, sum(a * ({_formula('item_id', 'j', 9)})) + {_formula('item_id', 0, 10)} - any_value(x) AS e
  FROM t JOIN code USING (user_id) GROUP BY user_id, item_id
),
l AS (SELECT count(*) * sqrt(avg(e * e) + 1e-8) AS nl FROM e),
back AS (
  SELECT user_id, j, any_value(a) AS a, sum(e * ({_formula('item_id', 'j', 9)})) * (1 - any_value(a) * any_value(a)) AS b
  FROM e JOIN code USING (user_id) GROUP BY user_id, j
),
g AS (
  SELECT item_id, j, sum(x * b) AS g_in, sum(e * a) AS g_out FROM e JOIN back USING (user_id) GROUP BY item_id, j
),
p AS (
  SELECT 'item' AS kind, item_id AS idx, j AS pos, g_in AS g, {_formula('item_id', 'j', 8)} AS v FROM g
  UNION ALL SELECT 'item', item_id, 700 + j, g_out, {_formula('item_id', 'j', 9)} FROM g
  UNION ALL SELECT 'item', item_id, 1400, sum(e), any_value({_formula('item_id', 0, 10)}) FROM e GROUP BY item_id
  UNION ALL SELECT 'net', 0, j, sum(b), any_value({_formula('j', 0, 11)}) FROM back GROUP BY j
),
still AS (
  SELECT item_id, j FROM (SELECT DISTINCT item_id FROM s WHERE item_id NOT IN (SELECT item_id FROM t)), (SELECT unnest(range(1401)) AS j)
)
SELECT kind, idx::BIGINT AS idx, pos::INTEGER AS pos, round(v - 0.1 * g / (SELECT nl FROM l), 6) + 0.0 AS value FROM p
UNION ALL
SELECT 'item', item_id::BIGINT, j::INTEGER, round(CASE WHEN j < 700 THEN {_formula('item_id', 'j', 8)}
  WHEN j < 1400 THEN {_formula('item_id', '(j - 700)', 9)} ELSE {_formula('item_id', 0, 10)} END, 6) + 0.0 FROM still"""

_RMSE = "round(sqrt(avg((y - p) * (y - p)) + 1e-8), 6)"

ORACLE: dict[str, str] = {
    "ratings_view": f"WITH {RATINGS} SELECT user_id, item_id, rating FROM r",
    "activity_users": f"WITH {RATINGS} SELECT user_id, count(*) AS n_ratings FROM r GROUP BY user_id",
    "activity_items": f"WITH {RATINGS} SELECT item_id, count(*) AS n_ratings FROM r GROUP BY item_id",
    "distinct_ids": f"""WITH {RATINGS}
SELECT 'user' AS side, count(DISTINCT user_id) AS n_distinct FROM r
UNION ALL SELECT 'item', count(DISTINCT item_id) FROM r""",
    "top_filter": f"WITH {TOP} SELECT user_id, item_id, rating FROM kept",
    "dense_ids": f"""WITH {TOP}
SELECT user_id, item_id, CAST(dense_rank() OVER (ORDER BY user_id) - 1 AS INTEGER) AS user_idx,
       CAST(dense_rank() OVER (ORDER BY item_id) - 1 AS INTEGER) AS item_idx, rating FROM kept""",
    "split_hash": f"WITH {LABELLED} SELECT user_id, item_id, split FROM s",
    "split_exact": f"""WITH {RATINGS}
SELECT user_id, item_id,
       CASE WHEN row_number() OVER (ORDER BY md5('42:' || user_id || ':' || item_id), user_id, item_id)
                 <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
FROM r""",
    "centered": f"""WITH {LABELLED}
SELECT user_id, item_id, split, round(rating - (SELECT m FROM gm), 6) + 0.0 AS rating FROM s""",
    "user_items": f"""WITH {LABELLED}
SELECT user_id, item_id // 1024 AS chunk, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS partners
FROM train GROUP BY user_id, item_id // 1024""",
    "item_users": f"""WITH {LABELLED}
SELECT item_id, user_id // 1024 AS chunk, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS partners
FROM train GROUP BY item_id, user_id // 1024""",
    "user_vectors": f"""WITH {LABELLED}
SELECT user_id, item_id // 1024 AS chunk,
       string_agg(item_id || '=' || format('{{:.1f}}', rating), ',' ORDER BY item_id) AS cells
FROM train GROUP BY user_id, item_id // 1024""",
    "extent": f"WITH {LABELLED} SELECT max(user_id) + 1 AS n_users, max(item_id) + 1 AS n_items FROM s",
    "user_stats": _stats("user_id"),
    "item_stats": _stats("item_id"),
    "user_neighbors": _neighbors_query("user_id", "item_id"),
    "item_neighbors": _neighbors_query("item_id", "user_id"),
    "user_knn_predict": _knn_predict("user_id", "item_id", "mean"),
    "user_knn_predict_zero": _knn_predict("user_id", "item_id", "zero"),
    "item_knn_predict": _knn_predict("item_id", "user_id", "mean"),
    "item_knn_predict_zero": _knn_predict("item_id", "user_id", "zero"),
    "user_knn_mse": _knn_mse("user_id", "item_id"),
    "item_knn_mse": _knn_mse("item_id", "user_id"),
    "mf_forward": _forward(_BILINEAR),
    "mf_forward_cold": f"""WITH {LABELLED},
a AS (SELECT user_id, item_id FROM s UNION ALL SELECT user_id + 1000000, item_id FROM s WHERE user_id % 50 = 0),
ku AS (SELECT DISTINCT user_id, true AS known_user FROM train), ki AS (SELECT DISTINCT item_id, true AS known_item FROM train)
SELECT user_id, item_id, round(
  CASE WHEN known_user THEN {_formula('user_id', 10, 0)} ELSE 0 END
  + CASE WHEN known_item THEN {_formula('item_id', 10, 1)} ELSE 0 END
  + CASE WHEN known_user AND known_item THEN
      list_sum([({_formula('user_id', 'f', 0)}) * ({_formula('item_id', 'f', 1)}) FOR f IN range(10)]) ELSE 0 END, 6) + 0.0 AS prediction
FROM a LEFT JOIN ku USING (user_id) LEFT JOIN ki USING (item_id)""",
    "als_optimality": f"WITH {LABELLED} SELECT DISTINCT user_id, 0.0::DOUBLE AS residual FROM train",
    "als_products": f"""WITH {LABELLED}
SELECT user_id, item_id, 0.0::DOUBLE AS gap FROM test
WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)""",
    "attached": f"""WITH {LABELLED}
SELECT user_id, item_id, rating, round((user_id * 31 + item_id * 17) % 101 / 20, 6) + 0.0 AS prediction
FROM s WHERE (user_id + item_id) % 7 <> 0""",
    "deep_forward": _forward(_PERCEPTRON),
    "residual_forward": _forward(f"{_BILINEAR} + {_PERCEPTRON}"),
    "autorec_forward": f"WITH {_CODER} SELECT user_id, item_id, round(p, 6) + 0.0 AS prediction FROM coded",
    "autorec_masked_rmse": f"WITH {_CODER} SELECT split, {_RMSE} AS rmse FROM coded GROUP BY split",
    "mf_rmse": f"WITH {_MF_SCORED} SELECT split, {_RMSE} AS rmse FROM scored GROUP BY split",
    "masked_rmse_zero": f"""WITH {_MF_SCORED}
SELECT split, round(sqrt(avg((r.rating - 2.5 - p) * (r.rating - 2.5 - p)) + 1e-8), 6) AS rmse
FROM scored JOIN r USING (user_id, item_id) WHERE r.rating <> 2.5 GROUP BY split""",
    "metrics_roundtrip": f"""WITH {_MF_SCORED}, e AS (SELECT split, {_RMSE} AS value FROM scored GROUP BY split)
SELECT 'mf' AS model, epoch::INTEGER AS epoch, split, 'rmse' AS metric, value FROM e, (SELECT unnest([0, 1]) AS epoch)""",
    "mf_batch_rmse": f"""WITH {_MF_SCORED},
numbered AS (SELECT *, (row_number() OVER (ORDER BY user_id, item_id) - 1) // 1000 AS batch FROM scored)
SELECT round(avg(e), 6) AS batch_rmse
FROM (SELECT sqrt(avg((y - p) * (y - p)) + 1e-8) AS e FROM numbered GROUP BY batch)""",
    "mf_sgd_step": f"""WITH {_MF_SCORED},
e AS (SELECT user_id, item_id, p - y AS e FROM scored WHERE split = 'train'),
l AS (SELECT count(*) * sqrt(avg(e * e) + 1e-8) AS nl FROM e),
pos AS (SELECT unnest(range(11)) AS pos),
g AS (
  SELECT 'user' AS kind, user_id AS idx, pos,
         sum(e * CASE WHEN pos = 10 THEN 1 ELSE {_formula('item_id', 'pos', 1)} END) AS g
  FROM e, pos GROUP BY user_id, pos
  UNION ALL
  SELECT 'item', item_id, pos, sum(e * CASE WHEN pos = 10 THEN 1 ELSE {_formula('user_id', 'pos', 0)} END)
  FROM e, pos GROUP BY item_id, pos
),
v AS (
  SELECT 'user' AS kind, user_id AS idx, pos, {_formula('user_id', 'pos', 0)} AS v
  FROM (SELECT DISTINCT user_id FROM s), pos
  UNION ALL
  SELECT 'item', item_id, pos, {_formula('item_id', 'pos', 1)} FROM (SELECT DISTINCT item_id FROM s), pos
)
SELECT kind, idx, CAST(pos AS INTEGER) AS pos,
       round(v - 1.0 * (coalesce(g, 0) / (SELECT nl FROM l) + 1e-5 * v), 6) + 0.0 AS value
FROM v LEFT JOIN g USING (kind, idx, pos)""",
    "roundtrip_buckets": f"""WITH {LABELLED}
SELECT test.user_id, test.item_id, count(*) AS n_train, sum(train.rating) AS sum_train
FROM test JOIN train ON test.user_id = train.user_id GROUP BY test.user_id, test.item_id""",
    "prepared_split": f"""WITH {RATINGS},
kept AS (
  SELECT * FROM r
  WHERE user_id IN (SELECT user_id FROM r GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 6000)
    AND item_id IN (SELECT item_id FROM r GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT 2000)
)
SELECT run, user_id, item_id, CAST(dense_rank() OVER (PARTITION BY run ORDER BY user_id) - 1 AS INTEGER) AS user_idx,
       CAST(dense_rank() OVER (PARTITION BY run ORDER BY item_id) - 1 AS INTEGER) AS item_idx, rating,
       CASE WHEN row_number() OVER (PARTITION BY run ORDER BY md5('42:' || user_id || ':' || item_id), user_id, item_id)
                 <= ceil(0.2 * count(*) OVER (PARTITION BY run)) THEN 'test' ELSE 'train' END AS split
FROM kept, (SELECT unnest(['loaded', 'again']) AS run)""",
    "deep_sgd_step": _network_step(False),
    "residual_sgd_step": _network_step(True),
    "autorec_sgd_step": _CODER_STEP,
    "user_batches": f"""WITH {LABELLED}
SELECT epoch::INTEGER AS epoch, (row_number() OVER (PARTITION BY epoch ORDER BY md5('42:' || epoch || ':' || user_id), user_id) - 1) // 128 AS batch, user_id
FROM (SELECT DISTINCT user_id FROM train), (SELECT unnest([0, 1]) AS epoch)""",
    "roundtrip_dat": f"WITH {RATINGS} SELECT user_id, item_id, rating FROM r",
    "roundtrip_csv": f"WITH {RATINGS} SELECT user_id AS user_idx, item_id AS item_idx, rating FROM r",
    "roundtrip_split": f"WITH {LABELLED} SELECT user_id, item_id, rating, split FROM s",
    "roundtrip_index": f"WITH {RATINGS} SELECT user_id, item_id, rating, rating AS rating_by_item FROM r",
}
ORACLE["mf_train_step"] = ORACLE["mf_sgd_step"]

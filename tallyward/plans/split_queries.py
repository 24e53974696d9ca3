"""Splits, folds, neighbours and resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.operators import neighbours as N
from tallyward.operators import resample as Rs
from tallyward.operators import splits as Sp
from tallyward.plans import views as V
from tallyward.plans.registry import query
from tallyward.plans.views import with_views
from tallyward.session import settle


def unit(key: str, stream) -> str:
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{stream}'),1,13))::UBIGINT / 4503599627370496.0::DOUBLE)"


def _h(stream: str) -> str:
    return f"SELECT *, {unit('transaction_id', stream)} AS h FROM tx"


_SPLIT = "CASE WHEN h<0.2::DOUBLE THEN 'test' WHEN h<0.2::DOUBLE+0.1::DOUBLE THEN 'validation' ELSE 'train' END"


@query("H1_class_split", with_views("tx", s=_h("split:42"), d=f"SELECT transaction_id, is_fraud, {_SPLIT} AS split FROM s") + "SELECT * FROM d WHERE split<>'train' OR is_fraud=0")
def h1(spark, sf):
    return Sp.class_split(V.tx(spark, sf), "transaction_id", "is_fraud").select("transaction_id", "is_fraud", "split")


@query(
    "H1_class_split_exact",
    with_views("tx", s=_h("exact_split:42"), o="SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY h, transaction_id)-1 AS o, count(*) OVER (PARTITION BY is_fraud) AS n FROM s")
    + """SELECT transaction_id, is_fraud, CASE WHEN o<round(n*0.2::DOUBLE) THEN 'test' WHEN o<round(n*0.2::DOUBLE)+round(n*0.1::DOUBLE) THEN 'validation' ELSE 'train' END AS split FROM o""",
)
def h1_exact(spark, sf):
    return Sp.exact_class_split(V.tx(spark, sf), "transaction_id", "is_fraud").select("transaction_id", "is_fraud", "split")


@query("H2_hold_out", with_views("tx", s=_h("hold_out:42")) + "SELECT transaction_id, CASE WHEN h<0.2::DOUBLE THEN 'test' ELSE 'train' END AS split FROM s")
def h2(spark, sf):
    return Sp.hold_out(V.tx(spark, sf), "transaction_id").select("transaction_id", "split")


@query(
    "H3_stratified_folds",
    with_views("tx", s=_h("stratified_folds:42")) + "SELECT transaction_id, is_fraud, CAST((row_number() OVER (PARTITION BY is_fraud ORDER BY h, transaction_id)-1)%5 AS INTEGER) AS fold FROM s",
)
def h3(spark, sf):
    return Sp.stratified_folds(V.tx(spark, sf), "transaction_id", "is_fraud").select("transaction_id", "is_fraud", "fold")


@query("H4_folds", with_views("tx", s=_h("folds:42")) + "SELECT transaction_id, CAST(floor(h*5) AS INTEGER) AS fold FROM s")
def h4(spark, sf):
    return V.tx(spark, sf).select("transaction_id", Sp.fold_of(F.col("transaction_id"), 5).alias("fold"))


def _ordered(order: str) -> str:
    return with_views("ord", o=f"SELECT transaction_id, row_number() OVER (ORDER BY {order})-1 AS o, count(*) OVER () AS n FROM ord") + """SELECT transaction_id,
    CASE WHEN o<floor(n*0.7::DOUBLE) THEN 'train' WHEN o<floor(n*0.85::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM o"""


@query("H5_ordered_split_by_time", _ordered("timestamp, transaction_id"))
def h5(spark, sf):
    return Sp.ordered_split(V.orders_tx(spark, sf), "timestamp", "transaction_id").select("transaction_id", "split")


@query("H5_ordered_split_by_user", _ordered("user_id, timestamp, transaction_id"))
def h5_user(spark, sf):
    return Sp.ordered_split(V.orders_tx(spark, sf), "timestamp", "transaction_id", order="user_time").select("transaction_id", "split")


_U = _h("undersample:42")
_N = "SELECT count(*) FILTER (is_fraud=1) AS n1, count(*) FILTER (is_fraud=0) AS n0 FROM tx"


@query("H6_undersample_share", with_views("tx", u=_U, n=_N) + "SELECT transaction_id, is_fraud FROM u, n WHERE is_fraud=1 OR h<n1/0.5::DOUBLE/n0")
def h6(spark, sf):
    return Sp.undersample(V.tx(spark, sf), "transaction_id", "is_fraud", 0.5).select("transaction_id", "is_fraud")


@query(
    "H6_undersample_exact",
    with_views("tx", u=_U, n=_N, o="SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY h, transaction_id)-1 AS o FROM u")
    + "SELECT transaction_id, is_fraud FROM o, n WHERE is_fraud=1 OR o<floor(n1/0.5::DOUBLE)",
)
def h6_exact(spark, sf):
    return Sp.undersample(V.tx(spark, sf), "transaction_id", "is_fraud", 0.5, exact=True).select("transaction_id", "is_fraud")


# neighbours

def knn_sql(a: str, b: str, k: int, self_ok: bool) -> str:
    skip = "" if self_ok else "WHERE a.row_id<>b.row_id"
    return f"""SELECT row_id, CAST(rank AS INTEGER) AS rank, neighbour, distance FROM (SELECT a.row_id, b.row_id AS neighbour, list_distance(a.features,b.features) AS distance,
    row_number() OVER (PARTITION BY a.row_id ORDER BY list_distance(a.features,b.features), b.row_id) AS rank FROM {a} a, {b} b {skip}) WHERE rank<={k}"""


_KNN_OUT = "SELECT row_id, rank, neighbour, round(distance,6) AS distance FROM k"


@query("C7_nearest_neighbours", with_views("vec", k=knn_sql("vec", "vec", 5, False)) + _KNN_OUT)
def c7(spark, sf):
    v = V.vec(spark, sf)
    return N.nearest_neighbours(v, v, 5, exclude_self=True).withColumn("distance", F.round("distance", 6))


@query("C7_nearest_neighbours_many_cells", with_views("vec", n="SELECT * FROM vec WHERE label=0", k=knn_sql("vec", "n", 3, True)) + _KNN_OUT)
def c7_cells(spark, sf):
    v = V.vec(spark, sf)
    out = N.nearest_neighbours(v, v.where(F.col("label") == 0), 3, pivots=16, block_rows=64)
    return out.withColumn("distance", F.round("distance", 6))


@query("C7_nearest_neighbours_hashed")
def c7_hashed(spark, sf):
    """The k = 5 nearest of every row by hash tables with multi-probe, ranked by exact distance."""
    v = V.vec(spark, sf)
    out = N.nearest_neighbours(v, v, 5, exclude_self=True, approximate=N.Hashing())
    return out.withColumn("distance", F.round("distance", 6))


@query("C7_hashed_recall")
def c7_recall(spark, sf):
    """Recall at k = 5 of the hashed path against the exact one, over every row: one row per query and the total."""
    v = V.vec(spark, sf)
    exact = N.nearest_neighbours(v, v, 5, exclude_self=True)
    found = N.nearest_neighbours(v, v, 5, exclude_self=True, approximate=N.Hashing())
    # A neighbour counts as found when the hashed path returns one at its distance (ties are interchangeable).
    at = exact.alias("e").join(
        found.alias("f"), (F.col("e.row_id") == F.col("f.row_id")) & (F.col("e.rank") == F.col("f.rank")), "left"
    )
    hit = (F.abs(F.col("f.distance") - F.col("e.distance")) <= 1e-9).cast("int")
    # written once: the rows and their total both read it
    per = settle(at.groupBy(F.col("e.row_id").alias("row_id")).agg(F.avg(F.coalesce(hit, F.lit(0))).alias("recall")))
    total = per.agg(F.lit(None).cast("long").alias("row_id"), F.avg("recall").alias("recall"))
    return per.unionByName(total)


@query(
    "I10_local_outlier_factor",
    with_views(
        "vec", n="SELECT * FROM vec WHERE label=0", inn=knn_sql("n", "n", 20, False), out=knn_sql("vec", "n", 20, True),
        kd="SELECT row_id AS neighbour, max(distance) AS kd FROM inn GROUP BY row_id",
        lo="SELECT row_id AS neighbour, 1.0::DOUBLE/(avg(greatest(kd,distance))+1e-10::DOUBLE) AS lrd FROM inn JOIN kd USING (neighbour) GROUP BY row_id",
        lx="SELECT row_id, 1.0::DOUBLE/(avg(greatest(kd,distance))+1e-10::DOUBLE) AS lrd FROM out JOIN kd USING (neighbour) GROUP BY row_id",
        ar="SELECT row_id, avg(lrd) AS around FROM out JOIN lo USING (neighbour) GROUP BY row_id",
    ) + "SELECT row_id, round(around/lrd,6) AS score FROM lx JOIN ar USING (row_id)",
)
def i10(spark, sf):
    return N.local_outlier_factor(V.vec(spark, sf)).withColumn("score", F.round("score", 6))


_RARE = "SELECT * FROM vec WHERE label=1"
_VN = "SELECT count(*) FILTER (label=1) AS n1, count(*) FILTER (label=0) AS n0, CAST(floor(0.5::DOUBLE*count(*) FILTER (label=0)) AS BIGINT)-count(*) FILTER (label=1) AS g FROM vec"
_MIX = """SELECT CAST(draw AS VARCHAR) AS draw, base, d.neighbour, CAST(i-1 AS INTEGER) AS dim, round(x.features[i]+u*(y.features[i]-x.features[i]),6) AS value
 FROM (SELECT *, unnest(range(1,65)) AS i FROM d) d JOIN rare x ON x.row_id=base JOIN rare y ON y.row_id=d.neighbour"""


@query(
    "H7_smote",
    with_views(
        "vec", rare=_RARE, n=_VN, k=knn_sql("rare", "rare", 5, False),
        o="SELECT row_id, row_number() OVER (ORDER BY row_id)-1 AS slot FROM rare",
        j="SELECT unnest(range(g)) AS draw, n1 FROM n",
        e=f"""SELECT draw, CAST(floor({unit('draw', '42:base')}*n1) AS BIGINT) AS slot, CAST(floor({unit('draw', '42:pick')}*5)+1 AS INTEGER) AS pick, {unit('draw', '42:u')} AS u FROM j""",
        d="SELECT draw, o.row_id AS base, u, k.neighbour FROM e JOIN o USING (slot) JOIN k ON k.row_id=o.row_id AND k.rank=pick",
    ) + _MIX,
)
def h7(spark, sf):
    return _show(Rs.smote(V.vec(spark, sf), ratio=0.5))


def _show(new):
    return new.select(
        F.col("draw").cast("string").alias("draw"), "base", "neighbour", F.posexplode("features").alias("dim", "value")
    ).withColumn("value", F.round("value", 6))


@query(
    "H8_adasyn",
    with_views(
        "vec", rare=_RARE, n=_VN, a=knn_sql("rare", "vec", 5, False), k=knn_sql("rare", "rare", 5, False),
        r="SELECT a.row_id AS base, avg(CAST(v.label=0 AS INTEGER)) AS r FROM a JOIN vec v ON v.row_id=a.neighbour GROUP BY 1",
        c="SELECT base, CAST(round(r/(SELECT sum(r) FROM r)*g) AS BIGINT) AS copies FROM r, n",
        j="SELECT base, unnest(range(1,copies+1)) AS copy FROM c",
        e=f"""SELECT base, base || '-' || copy AS draw, CAST(floor({unit("base || '-' || copy", '42:pick')}*5)+1 AS INTEGER) AS pick, {unit("base || '-' || copy", '42:u')} AS u FROM j""",
        d="SELECT draw, base, u, k.neighbour FROM e JOIN k ON k.row_id=base AND k.rank=pick",
    ) + _MIX,
)
def h8(spark, sf):
    return _show(Rs.adasyn(V.vec(spark, sf), ratio=0.5))


@query(
    "G6_stack_synthetic_rows",
    with_views("vec", n=_VN) + "SELECT label, false AS synthetic, count(*) AS rows FROM vec GROUP BY label UNION ALL SELECT CAST(1 AS INTEGER), true, g FROM n",
)
def g6(spark, sf):
    v = V.vec(spark, sf)
    return Rs.with_synthetic(v, Rs.smote(v, ratio=0.5)).groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("rows"))

"""One query for each operator over the stand-in tables, and the SQL that DuckDB must agree with.

``events`` stands for recordings: a user is an episode, an event type a stream, the value a motion signal. Elements 1 to
16 of ``embeddings`` stand for state and action vectors, its label for an episode.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions import names as N
from tracewright.functions import quaternion as Q
from tracewright.operators import align, asof, assemble, motion, planning, quality, validators
from tracewright.schema import CAMERA_FEATURES
from tracewright.sources import listing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
HOUR = 3_600_000_000


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with t, microseconds since the epoch, whatever the session's time zone."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return table(spark, sf_dir, "events").withColumn("t", micros.cast("bigint"))


def stream(ev: DataFrame, kind: str, *more: str) -> DataFrame:
    return ev.where(F.col("event_type") == kind).select("user_id", "event_id", "t", *more)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("label", "vec_id", F.slice("embedding", 1, 16).alias("v"))


def moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return motion.deltas(events(spark, sf_dir), ["user_id"], ["ts", "event_id"], ["value"])


def rounded(x: Column, digits: int = 6) -> Column:
    """``x`` rounded half away from zero; as in SQL, a zero keeps the sign of what it is rounded from."""
    return F.when(x < 0, -F.round(-x, digits)).when(x == 0, x).otherwise(F.round(x, digits))


# ---- names and texts

_NAMES = """
with n as (select event_id, event_id % 7 k, epoch_us(ts) * 1000 ns, user_id from events),
m as (select event_id, case k when 0 then 'frame' || ns || '_left.jpg' when 1 then 'frame' || event_id || '_right_' || (ns // 1000000000) || '_' || (ns % 1000000000) || '.jpg'
  when 2 then 'frame' || event_id || 'center.jpg' when 3 then 'frame_missing.jpg' when 4 then 'left_' || event_id || '.jpg' when 5 then 'frame' || event_id || '_left.png' else 'frame000000_psm1_10_500.jpg' end as name from n)
"""


@query(
    _NAMES
    + r"""select event_id, name,
 coalesce(try_cast(regexp_extract(name, 'frame\d+_(?:left|right|psm1|psm2)_(\d+)_(\d+)\.jpg', 1) as bigint) * 1000000000 + try_cast(regexp_extract(name, 'frame\d+_(?:left|right|psm1|psm2)_(\d+)_(\d+)\.jpg', 2) as bigint), try_cast(regexp_extract(name, 'frame(\d+)_\w+\.jpg', 1) as bigint)) strict,
 coalesce(try_cast(regexp_extract(name, 'frame\d+_(?:left|right|psm1|psm2)_(\d+)_(\d+)\.jpg', 1) as bigint) * 1000000000 + try_cast(regexp_extract(name, 'frame\d+_(?:left|right|psm1|psm2)_(\d+)_(\d+)\.jpg', 2) as bigint), try_cast(regexp_extract(name, 'frame(\d+)', 1) as bigint)) lenient from m"""
)
def filename_timestamp(spark, sf_dir):
    ns, i, k = F.col("t") * 1000, F.col("event_id").cast("string"), F.col("event_id") % 7
    text = lambda *x: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in x])
    name = (
        F.when(k == 0, text("frame", ns.cast("string"), "_left.jpg"))
        .when(k == 1, text("frame", i, "_right_", F.floor(ns / 1_000_000_000).cast("string"), "_", (ns % 1_000_000_000).cast("string"), ".jpg"))
        .when(k == 2, text("frame", i, "center.jpg"))
        .when(k == 3, F.lit("frame_missing.jpg"))
        .when(k == 4, text("left_", i, ".jpg"))
        .when(k == 5, text("frame", i, "_left.png"))
        .otherwise(F.lit("frame000000_psm1_10_500.jpg"))
    )
    rows = events(spark, sf_dir).select("event_id", name.alias("name"))
    return rows.select("event_id", "name", N.frame_timestamp(F.col("name")).alias("strict"), N.frame_timestamp(F.col("name"), lenient=True).alias("lenient"))


@query(
    r"""with n as (select user_id, event_id, 'frame' || (event_id % 97) || '_left_' || (epoch_us(ts) // 1000000) || '_' || (epoch_us(ts) % 1000000) || '.jpg' as name, event_id % 97 seq,
 (epoch_us(ts) // 1000000) * 1000000000 + epoch_us(ts) % 1000000 ns from events),
r as (select user_id, event_id, row_number() over (partition by user_id order by ns, event_id) by_time, row_number() over (partition by user_id order by seq, name, event_id) by_number,
 row_number() over (partition by user_id order by name, event_id) by_name from n)
select user_id, event_id, by_time, by_number, by_name from r where by_time <> by_number or by_number <> by_name"""
)
def frame_order(spark, sf_dir):
    ev = events(spark, sf_dir)
    name = F.concat(F.lit("frame"), (F.col("event_id") % 97).cast("string"), F.lit("_left_"), F.floor(F.col("t") / 1_000_000).cast("string"), F.lit("_"), (F.col("t") % 1_000_000).cast("string"), F.lit(".jpg"))
    rows = ev.select("user_id", "event_id", name.alias("name")).withColumn("ns", N.frame_timestamp(F.col("name"))).withColumn("seq", N.frame_number(F.col("name")))
    for column, order in (("by_time", ["ns"]), ("by_number", ["seq", "name"]), ("by_name", ["name"])):
        rows = planning.numbered_episodes(rows, ["user_id"], [*order, "event_id"], column)
    return rows.where("by_time <> by_number OR by_number <> by_name").select("user_id", "event_id", "by_time", "by_number", "by_name")


@query(
    r"""with k as (select page_id, regexp_extract(url, '://([^/]*)', 1) site, list_transform(list_filter(regexp_extract_all(lower(url), '[^0-9]*[0-9]*'), lambda p: p <> ''),
  lambda p: {'t': regexp_extract(p, '^[^0-9]*'), 'n': coalesce(try_cast(regexp_extract(p, '[0-9]+$') as hugeint), -1)}) as k from pages)
select page_id, site, row_number() over (partition by site order by k, page_id) as place from k"""
)
def natural_sort(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "://([^/]*)", 1).alias("site"), N.natural_key(F.col("url")).alias("k"))
    return planning.numbered_episodes(pages, ["site"], ["k", "page_id"], "place").select("page_id", "site", "place")


@query(
    """with p as (select c_custkey, c_custkey % 5 k, r_name, n_nationkey, 'Collector' || (c_custkey % 3) c, 'phase' || (c_custkey % 4) ph, (c_custkey % 9) || '_Action' || (c_custkey % 2) a
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
select c_custkey, case when k < 4 then cast(n_nationkey as bigint) end tissue_num, case when k = 3 then c when k < 4 then '' end collector,
 case when k in (2, 3) then ph when k < 4 then '' end phase, case when k between 1 and 3 then a when k = 0 then 'Tissue#' || n_nationkey end as action,
 case when k between 1 and 3 then 'action' || (c_custkey % 2) when k = 0 then 'tissue#' || n_nationkey end plain from p"""
)
def path_parse(spark, sf_dir):
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    k, key = F.col("c_custkey") % 5, F.col("c_custkey")
    tissue = F.concat(F.when(k == 4, F.lit("Organ#")).otherwise(F.lit("Tissue#")), F.col("n_nationkey").cast("string"))
    part = [F.when(k == 3, F.concat(F.lit("Collector"), (key % 3).cast("string"))), F.when(k.isin(2, 3), F.concat(F.lit("phase"), (key % 4).cast("string"))), F.when(k > 0, F.concat((key % 9).cast("string"), F.lit("_Action"), (key % 2).cast("string")))]
    rows = c.select("c_custkey", F.concat_ws("/", "r_name", tissue, *part).alias("path")).withColumn("d", N.direct_parts(F.col("path")))
    return rows.select("c_custkey", "d.tissue_num", "d.collector", "d.phase", "d.action", N.unnumbered(F.col("d.action")).alias("plain"))


@query(
    """select s_suppkey, case when s_suppkey % 3 < 2 then cast(s_nationkey as bigint) end tissue, case s_suppkey % 3 when 0 then 'rec_' || s_suppkey when 1 then '2026_' || s_suppkey end as session,
 case s_suppkey % 3 when 1 then 'col_' || (s_suppkey % 4) end collector from supplier"""
)
def session_parse(spark, sf_dir):
    k, n = F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")
    name = (
        F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("cautery_tissue"), n, F.lit("_rec_"), k, F.lit("_left_video")))
        .when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit("col_"), (F.col("s_suppkey") % 4).cast("string"), F.lit("_tissue"), n, F.lit("_2026_"), k))
        .otherwise(F.concat(F.lit("some_bad_session"), k))
    )
    return table(spark, sf_dir, "supplier").select("s_suppkey", N.session_parts(name).alias("s")).select("s_suppkey", "s.tissue", "s.session", "s.collector")


@query(
    r"""with t as (select p_partkey, (p_partkey % 4) || '_' || replace(p_name, ' ', '_') || case when p_partkey % 5 = 0 then '_recovery' else '' end as x from part),
u as (select p_partkey, x, replace(x[instr(x, '_') + 1:], '_', ' ') planned from t)
select p_partkey, planned, regexp_replace(replace(x, '_', ' '), '^[0-9]+ ', '') direct, case when planned like '%recovery' then left(planned, greatest(length(planned) - 9, 0)) else planned end as old, replace(x, '_', ' ') flat,
 contains(lower(planned), 'recovery') recovery, case when contains(lower(planned), 'recovery') then trim(replace(replace(planned, ' recovery', ''), 'recovery', '')) else planned end as stripped from u"""
)
def task_text(spark, sf_dir):
    p = F.col("p_partkey")
    text = F.concat((p % 4).cast("string"), F.lit("_"), F.translate("p_name", " ", "_"), F.when(p % 5 == 0, F.lit("_recovery")).otherwise(F.lit("")))
    rows = table(spark, sf_dir, "part").select("p_partkey", text.alias("x"))
    x, planned = F.col("x"), N.planned_task(F.col("x"))
    return rows.select("p_partkey", planned.alias("planned"), N.direct_task(x).alias("direct"), N.old_task(x).alias("old"), N.flat_task(x).alias("flat"), N.is_recovery(planned).alias("recovery"), N.without_recovery(planned).alias("stripped"))


@query(
    """with s as (select o_orderkey, cast(trunc(o_totalprice / 40) as bigint) s from orders)
select o_orderkey, case when s < 60 then s || 's' when s // 60 < 60 then printf('%dm %02ds', s // 60, s % 60) else printf('%dh %02dm %02ds', s // 3600, s // 60 % 60, s % 60) end as text from s"""
)
def duration_text(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", N.duration_text(F.col("o_totalprice") / 40).alias("text"))


@query("select event_id, printf('%.4f', (row_number() over (partition by user_id order by ts, event_id) - 1) * (1.0::double / 30)) as timestamp from events")
def timestamp_normalize(spark, sf_dir):
    rows = align.indexed(events(spark, sf_dir), ["user_id"], ["ts", "event_id"])
    return rows.select("event_id", N.normalized_time(F.col("idx"), 30).alias("timestamp"))


@query("select event_id, 'frame' || printf('%06d', row_number() over (partition by user_id, event_type order by ts, event_id) - 1) || '_' || event_type || '.jpg' as name from events")
def frame_rename(spark, sf_dir):
    rows = align.indexed(events(spark, sf_dir), ["user_id", "event_type"], ["ts", "event_id"])
    return rows.select("event_id", N.frame_name(F.col("idx"), F.concat(F.lit("_"), F.col("event_type")), ".JPG").alias("name"))


@query("select event_id, (row_number() over (partition by user_id order by ts, event_id) - 1) * 33333333 as timestamp_ns from events")
def synthetic_ts(spark, sf_dir):
    rows = align.indexed(events(spark, sf_dir), ["user_id"], ["ts", "event_id"])
    return rows.select("event_id", (F.col("idx") * 33_333_333).alias("timestamp_ns"))


@query("select event_id, case event_type when 'view' then 'observation.images.endoscope.left' when 'click' then 'observation.images.endoscope.right' when 'purchase' then 'observation.images.wrist.right' when 'signup' then 'observation.images.wrist.left' end as feature from events")
def camera_map(spark, sf_dir):
    stand_in = dict(zip(("view", "click", "purchase", "signup"), CAMERA_FEATURES.values(), strict=True))
    pairs = F.create_map(*[F.lit(x) for kv in stand_in.items() for x in kv])
    return events(spark, sf_dir).select("event_id", F.try_element_at(pairs, F.col("event_type")).alias("feature"))


# ---- synchronisation


def _nearest_sql(build: str, less: str = "<", unit: str = "epoch_us(ts)") -> str:
    return f"""l as (select event_id lid, user_id, {unit} t from events where event_type = 'view'),
c as (select event_id cid, user_id, {unit} t from events where event_type = '{build}'),
lo as (select user_id, t, max(cid) cid from c group by 1, 2), hi as (select user_id, t, min(cid) cid from c group by 1, 2),
p as (select l.*, lo.cid pc, lo.t pt from l asof left join lo on l.user_id = lo.user_id and l.t > lo.t),
n as (select p.*, hi.cid nc, hi.t nt from p asof left join hi on p.user_id = hi.user_id and p.t <= hi.t),
m as (select lid, user_id, t, case when nt is null or t - pt {less} nt - t then pc else nc end cid, case when nt is null or t - pt {less} nt - t then pt else nt end ct from n)"""


@query(f"with {_nearest_sql('click')} select lid, cid, t - ct as diff from m")
def nearest_sync(spark, sf_dir):
    ev = events(spark, sf_dir)
    out = asof.nearest(stream(ev, "view"), stream(ev, "click"), ["user_id"], "t", "event_id")
    return out.select(F.col("event_id").alias("lid"), F.col("match.event_id").alias("cid"), (F.col("t") - F.col("match.t")).alias("diff"))


@query(f"with {_nearest_sql('click', '<=', 'epoch_us(ts) // 3600000000')} select lid, cid, t - ct as diff from m")
def nearest_tie_left(spark, sf_dir):
    ev = events(spark, sf_dir).withColumn("t", F.floor(F.col("t") / HOUR))
    out = asof.nearest(stream(ev, "view"), stream(ev, "click"), ["user_id"], "t", "event_id", tie="earlier")
    return out.select(F.col("event_id").alias("lid"), F.col("match.event_id").alias("cid"), (F.col("t") - F.col("match.t")).alias("diff"))


@query(
    f"""with {_nearest_sql('click')} select user_id, count(*) filter (where abs(t - ct) <= 4 * {HOUR}) kept, count(*) filter (where abs(t - ct) > 4 * {HOUR}) removed,
 min(abs(t - ct)) filter (where abs(t - ct) > 4 * {HOUR}) least, max(abs(t - ct)) filter (where abs(t - ct) > 4 * {HOUR}) most from m where cid is not null group by user_id"""
)
def sync_outliers(spark, sf_dir):
    ev = events(spark, sf_dir)
    out = asof.synchronized(stream(ev, "view"), stream(ev, "click").withColumnRenamed("event_id", "kin_idx"), ["user_id"], ts="t", tolerance_ms=None)
    return asof.outlier_figures(out, ["user_id"], "time_diff_ns", 4 * HOUR)


_DAY = 24 * HOUR


def _multi_sql() -> str:
    parts = []
    for name in ("click", "purchase", "signup"):
        body = _nearest_sql(name)
        for a in ("l", "c", "lo", "hi", "p", "n", "m"):
            body = body.replace(f"{a} as (", f"{name}_{a} as (") if a in ("l", "c", "p", "n", "m") else body.replace(f"{a} as (", f"{name}_{a} as (")
        body = body.replace("from l asof left join lo on l.user_id = lo.user_id and l.t > lo.t", f"from {name}_l l asof left join {name}_lo lo on l.user_id = lo.user_id and l.t > lo.t")
        body = body.replace("from p asof left join hi on", f"from {name}_p p asof left join {name}_hi hi on").replace("from c group", f"from {name}_c group").replace("end ct from n)", f"end ct from {name}_n)")
        parts.append(body)
    joined = "select a.lid, a.user_id, a.t, a.cid click, b.cid purchase, c.cid signup, a.ct click_t, b.ct purchase_t, c.ct signup_t from click_m a join purchase_m b using (lid) join signup_m c using (lid)"
    return "with " + ",\n".join(parts) + f",\nj as ({joined} where abs(a.t - a.ct) <= {_DAY} and abs(b.t - b.ct) <= {_DAY} and abs(c.t - c.ct) <= {_DAY})"


def _multi(spark, sf_dir):
    ev = events(spark, sf_dir)
    return asof.all_matching(stream(ev, "view"), {k: stream(ev, k) for k in ("click", "purchase", "signup")}, ["user_id"], "t", "event_id", _DAY)


@query(_multi_sql() + " select lid, click, purchase, signup from j")
def multicam_sync(spark, sf_dir):
    return _multi(spark, sf_dir).select(F.col("event_id").alias("lid"), *[F.col(f"{k}.event_id").alias(k) for k in ("click", "purchase", "signup")])


@query(
    _multi_sql()
    + """, x as (select lid, 'frame' || lid || '_left_' || (t // 1000000) || '_' || (t % 1000000) || '.jpg' l, user_id from j)
select x.lid, 'left' camera, l dst from x union all
select j.lid, 'right', 'frame' || j.lid || '_right_' || (click_t // 1000000000) || '_' || (click_t % 1000000000) || '.jpg' from j union all
select j.lid, 'psm1', 'frame' || j.lid || '_psm1_' || (purchase_t // 1000000000) || '_' || (purchase_t % 1000000000) || '.jpg' from j union all
select j.lid, 'psm2', 'frame' || j.lid || '_psm2_' || (signup_t // 1000000000) || '_' || (signup_t % 1000000000) || '.jpg' from j"""
)
def copy_manifest(spark, sf_dir):
    m = _multi(spark, sf_dir)
    left = F.concat(F.lit("frame"), F.col("event_id").cast("string"), F.lit("_left_"), F.floor(F.col("t") / 1_000_000).cast("string"), F.lit("_"), (F.col("t") % 1_000_000).cast("string"), F.lit(".jpg"))
    m = m.select(F.col("event_id").alias("lid"), left.alias("left"), *[F.col(f"{k}.t").alias(f"{c}_t") for k, c in (("click", "right"), ("purchase", "psm1"), ("signup", "psm2"))], *[F.col(f"{k}.event_id").cast("string").alias(f"{c}_n") for k, c in (("click", "right"), ("purchase", "psm1"), ("signup", "psm2"))])
    return planning.copy_manifest(m, "left", {c: (f"{c}_n", f"{c}_t") for c in ("right", "psm1", "psm2")}).select("lid", "camera", "dst")


@query(f"with {_nearest_sql('error')} select lid, cid, value from m join events on event_id = cid where abs(t - ct) <= {_DAY}")
def filtered_kinematics(spark, sf_dir):
    ev = events(spark, sf_dir)
    kin = stream(ev, "error", "value").withColumnRenamed("event_id", "kin_idx")
    sync = asof.synchronized(stream(ev, "view"), kin.drop("value"), ["user_id"], ts="t", tolerance_ms=_DAY / 1e6).select("user_id", F.col("event_id").alias("lid"), "kinematics_idx")
    return asof.gathered(sync, kin, ["user_id"]).select("lid", F.col("kin_idx").alias("cid"), "value")


@query(f"with {_nearest_sql('click')} select user_id, count(*) n from m where abs(t - ct) <= {_DAY} group by user_id having count(*) >= 10")
def min_images(spark, sf_dir):
    ev = events(spark, sf_dir)
    sync = asof.synchronized(stream(ev, "view"), stream(ev, "click").withColumnRenamed("event_id", "kin_idx"), ["user_id"], ts="t", tolerance_ms=_DAY / 1e6)
    return asof.with_enough(sync, ["user_id"], 10)


@query("select distinct user_id from events where user_id % 3 <> 0")
def skip_existing(spark, sf_dir):
    ev = events(spark, sf_dir).select("user_id").distinct()
    return planning.not_done(ev, ev.where("user_id % 3 = 0"), ["user_id"])


# One recording that holds all rows, cut into parts of a day (of ids for the vectors).

@query(f"with {_nearest_sql('click').replace('user_id', 'rec').replace('rec, epoch_us', '0 as rec, epoch_us')} select lid, cid, t - ct as diff from m")
def long_sync(spark, sf_dir):
    ev = events(spark, sf_dir).withColumn("rec", F.lit(0))
    view, click = (ev.where(F.col("event_type") == k).select("rec", "event_id", "t") for k in ("view", "click"))
    out = asof.nearest(view, click, ["rec"], "t", "event_id", span=_DAY)
    return out.select(F.col("event_id").alias("lid"), F.col("match.event_id").alias("cid"), (F.col("t") - F.col("match.t")).alias("diff"))


@query("select event_id, row_number() over (order by ts, event_id) - 2 as t, round(abs(value - lag(value) over (order by ts, event_id)), 6) as delta from events")
def long_delta(spark, sf_dir):
    ev = events(spark, sf_dir).select(F.lit(0).alias("rec"), "event_id", F.col("t").alias("at"), "value")
    return motion.deltas(ev, ["rec"], ["at", "event_id"], ["value"], span=_DAY).select("event_id", "t", F.round("delta", 6).alias("delta"))


@query(
    """with q as (select vec_id, list_transform(embedding[4:7], lambda x: x::double) q from embeddings), l as (select vec_id, q, lag(q) over (order by vec_id) p from q),
d as (select vec_id, list_sum([q[1] * p[1], q[2] * p[2], q[3] * p[3], q[4] * p[4]]) dot from l)
select vec_id, cast(case when sum(case when dot < 0 then 1 else 0 end) over (order by vec_id) % 2 = 0 then 1 else -1 end as int) sign from d"""
)
def long_signs(spark, sf_dir):
    rows = vectors(spark, sf_dir).select(F.lit(0).alias("rec"), "vec_id", Q.orientation(F.col("v"), 0).alias("q"))
    return motion.quaternion_signs(rows, ["rec"], ["vec_id"], "q", span=64).select("vec_id", "sign")


@query(
    """with ref as (select epoch_us(ts) t, row_number() over (order by ts, event_id) - 1 i from events), src as (select epoch_us(ts) t from events where value > 10), m as (select count(*) m from src),
b as (select a.i p, a.t t1, b.t t2 from ref a join ref b on b.i = a.i + 9 where a.i % 10 = 0), u as (select p, t1 as x, 0 as o, 0 as s from b union all select p, t2, 2, 0 from b union all select null, t, 1, 1 from src),
k as (select p, o, sum(s) over (order by x, o rows unbounded preceding) k from u), f as (select p, max(k) filter (where o = 0) s, max(k) filter (where o = 2) - 1 e from k where p is not null group by p)
select p, cast(greatest(0, least(s, m - 1)) as bigint) src_start, cast(greatest(0, least(e, m - 1)) as bigint) src_end from f, m"""
)
def long_align(spark, sf_dir):
    ev = events(spark, sf_dir).select(F.lit(0).alias("rec"), "event_id", "t", "value")
    ref = planning.positions(ev, ["rec"], ["t", "event_id"], F.floor(F.col("t") / _DAY), "idx", "n")
    plan = ref.where("idx % 10 = 0 AND idx + 9 < n").select("rec", F.col("idx").alias("p"), F.col("idx").alias("start"), (F.col("idx") + 9).alias("end"))
    return align.align_ranges(plan, ref, ev.where("value > 10"), ["rec"], ["p"], ts="t", span=_DAY).select("p", "src_start", "src_end")


# ---- discovery and plans


@query("select user_id from events group by user_id, cast(ts as date) having bool_or(event_type = 'view') and bool_or(event_type = 'error')")
def episode_discovery(spark, sf_dir):
    ev = events(spark, sf_dir).select("user_id", F.to_date("ts").alias("day"), "event_type")
    entry = F.when(F.col("event_type") == "view", F.lit("left_img_dir")).when(F.col("event_type") == "error", F.lit("ee_csv.csv")).otherwise(F.col("event_type"))
    files = ev.select(F.struct("user_id", "day").alias("episode_id"), entry.alias("entry"))
    return planning.episodes(files).select("episode_id.user_id")


@query("select user_id, cast(cast(ts as date) as varchar) as day from events where event_type <> 'error' group by user_id, cast(ts as date) having count(distinct event_type) = 4")
def run_completeness(spark, sf_dir):
    ev = events(spark, sf_dir).select("user_id", F.to_date("ts").cast("string").alias("day"), "event_type")
    return planning.complete_runs(ev, ["user_id", "day"], "event_type", ["view", "click", "purchase", "signup"])


@query(
    """with h as (select user_id, cast(cast(ts as date) as varchar) as day, bool_or(event_type = 'view') v, bool_or(event_type = 'click') c, bool_or(event_type = 'error') e from events group by 1, 2)
select user_id, day, v and c and e as valid, concat_ws('; ', case when not v then 'missing view' end, case when not c then 'missing click' end, case when not e then 'missing error' end) as message from h"""
)
def episode_validation(spark, sf_dir):
    ev = events(spark, sf_dir).select("user_id", F.to_date("ts").cast("string").alias("day"), "event_type")
    return planning.validated(ev, ["user_id", "day"], "event_type", ["view", "click", "error"])


@query(
    """with k as (select user_id, event_type, count(*) k from events where event_type <> 'error' group by 1, 2), s as (select user_id, min(k) shortest from k group by 1)
select user_id, shortest, user_id % 5 as start, least(user_id % 5 + 12, shortest - 1) as "end", least(user_id % 5 + 12, shortest - 1) - user_id % 5 + 1 as n_frames from s where least(user_id % 5 + 12, shortest - 1) - user_id % 5 + 1 > 0"""
)
def camera_clamp(spark, sf_dir):
    ev = events(spark, sf_dir)
    plan = ev.select("user_id").distinct().select("user_id", (F.col("user_id") % 5).alias("start"), (F.col("user_id") % 5 + 12).alias("end"))
    return planning.clamped_ends(plan, ev.where("event_type <> 'error'"), ["user_id"], "event_type")


_RUNS = f"""with {_nearest_sql('click')}, u as (select user_id, bool_or(event_type = 'view') and bool_or(event_type = 'error') ok from events group by 1),
k as (select user_id, count(*) n from m where abs(t - ct) <= {_DAY} group by 1), s as (select u.user_id, ok, coalesce(n, 0) n from u left join k using (user_id))"""


def _runs(spark, sf_dir):
    ev = events(spark, sf_dir)
    ok = planning.validated(ev, ["user_id"], "event_type", ["view", "error"])
    sync = asof.synchronized(stream(ev, "view"), stream(ev, "click").withColumnRenamed("event_id", "kin_idx"), ["user_id"], ts="t", tolerance_ms=_DAY / 1e6)
    return ok.join(asof.with_enough(sync, ["user_id"], 1), "user_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query(_RUNS + " select count(*) total, count(*) filter (where ok) valid, count(*) filter (where ok and n >= 10) synced, cast(coalesce(sum(n) filter (where ok and n >= 10), 0) as bigint) images from s")
def run_stats(spark, sf_dir):
    return planning.run_figures(_runs(spark, sf_dir), 10)


@query(_RUNS + " select user_id, n from s where not (ok and n >= 10)")
def skipped_runs(spark, sf_dir):
    return planning.skipped_runs(_runs(spark, sf_dir), 10).select("user_id", "n")


@query("select event_id, row_number() over (partition by user_id order by ts, event_id) - 1 as idx from events qualify event_type = 'view'")
def frame_lookup(spark, sf_dir):
    ev = events(spark, sf_dir)
    index = align.indexed(ev, ["user_id"], ["ts", "event_id"]).select("event_id", "idx")
    return planning.looked_up(ev.where("event_type = 'view'").select("event_id"), index, "event_id", "idx")


@query("select distinct 'tissue_' || case when c_custkey % 17 = 0 then 'x' else (c_custkey % 17)::varchar end as path, nullif(c_custkey % 17, 0) as number from customer")
def folder_order(spark, sf_dir):
    k = F.col("c_custkey") % 17
    name = F.concat(F.lit("tissue_"), F.when(k == 0, F.lit("x")).otherwise(k.cast("string")))
    entries = table(spark, sf_dir, "customer").select(name.alias("path"), F.lit("").alias("parent"), name.alias("name"), F.lit(True).alias("is_dir")).distinct()
    return listing.numbered_folders(entries)


@query("select 'Collector' || (c_custkey % 3) || '/Tissue#' || (c_custkey % 5) || '/run' || c_custkey as path, 'out_Collector' || (c_custkey % 3) || '_Tissue' || (c_custkey % 5) || '_run' || c_custkey || '.mp4' as output, 'Tissue#' || (c_custkey % 5) || '/run' || c_custkey as label, c_custkey % 5 as tissue from customer")
def video_runs(spark, sf_dir):
    k = F.col("c_custkey")
    parent = F.concat_ws("/", F.concat(F.lit("Collector"), (k % 3).cast("string")), F.concat(F.lit("Tissue#"), (k % 5).cast("string")), F.concat(F.lit("run"), k.cast("string")))
    entries = table(spark, sf_dir, "customer").select(parent.alias("parent"), F.lit("left_img_dir").alias("name"), F.lit(True).alias("is_dir"), F.lit(4).alias("depth"))
    runs = listing.video_runs(entries, "out").withColumn("label", N.short_label(F.col("path")))
    return runs.withColumn("tissue", N.tissue_number(F.replace("path", F.lit("#"), F.lit("_"))))


_PLAN = """a as (select event_id, user_id, event_type, cast(json_extract(props, '$.k') as int) s from events),
p as (select event_id, user_id, event_type, case event_type when 'click' then '1_grasp' when 'view' then '2_dissect' else event_type end subdir, s as start, s + 10 as "end" from a where s is not null)"""


def _plan(spark, sf_dir):
    ev = events(spark, sf_dir)
    k = F.get_json_object("props", "$.k").cast("int")
    action = F.when(F.col("event_type") == "click", F.lit("Grasp ")).when(F.col("event_type") == "view", F.lit("dissect")).otherwise(F.col("event_type"))
    raw = ev.select("event_id", "user_id", F.to_json(F.struct(action.alias("action"), F.struct(k.cast("string").alias("start"), (k + 10).cast("string").alias("end")).alias("affordance_range"))).alias("value"))
    return planning.parsed_annotations(raw).withColumn("subdir", planning.action_subdir(F.col("action")))


@query(f"with {_PLAN} select event_id, subdir, start, \"end\", row_number() over (partition by user_id, subdir order by event_id) episode_no from p")
def annotation_plan(spark, sf_dir):
    return planning.numbered_episodes(_plan(spark, sf_dir), ["user_id", "subdir"], ["event_id"]).select("event_id", "subdir", "start", "end", "episode_no")


@query("select event_id, row_number() over (partition by event_type, user_id % 4 order by event_id) planned, row_number() over (partition by event_type, user_id % 4, user_id % 3, user_id order by event_id) direct from events")
def episode_numbering(spark, sf_dir):
    ev = events(spark, sf_dir).withColumns({"tissue": F.col("user_id") % 4, "phase": F.col("user_id") % 3})
    one = planning.numbered_episodes(ev, ["event_type", "tissue"], ["event_id"], "planned")
    return planning.numbered_episodes(one, ["event_type", "tissue", "phase", "user_id"], ["event_id"], "direct").select("event_id", "planned", "direct")


@query("select event_type as action, dense_rank() over (order by event_type) || '_' || event_type as numbered from (select distinct event_type from events)")
def action_numbering(spark, sf_dir):
    return planning.action_numbers(events(spark, sf_dir), "event_type").withColumnRenamed("event_type", "action")


@query("select s_suppkey, case when s_suppkey % 2 = 0 then 'new/' || s_suppkey else 'old/' || s_suppkey end as resolved from supplier where s_suppkey % 2 = 0 or s_suppkey % 3 = 0")
def path_resolution(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey")
    k = F.col("s_suppkey").cast("string")
    new, old = F.concat(F.lit("new/"), k), F.concat(F.lit("old/"), k)
    existing = s.where("s_suppkey % 2 = 0").select(new.alias("path")).unionByName(s.where("s_suppkey % 3 = 0").select(old.alias("path")))
    return planning.resolved_paths(s, [(new, "new"), (old, "old")], existing)


# ---- motion

_DELTAS = """d as (select user_id, event_id, row_number() over (partition by user_id order by ts, event_id) - 2 t, abs(value - lag(value) over (partition by user_id order by ts, event_id)) delta from events),
a as (select user_id, count(*) n, min(case when delta > 150 then t end) f, max(case when delta > 150 then t end) l from d group by user_id),
r as (select user_id, n as n_rows, coalesce(f, 0) s, coalesce(least(l + 1, n - 1), n - 1) e from a)"""


def _ranges(spark, sf_dir):
    return motion.trim_ranges(moved(spark, sf_dir), ["user_id"], 150.0)


@query(f"with {_DELTAS} select event_id, t, round(delta, 6) as delta from d")
def motion_delta(spark, sf_dir):
    return moved(spark, sf_dir).select("event_id", "t", F.round("delta", 6).alias("delta"))


@query(f"with {_DELTAS} select user_id, n_rows, s as start, e as \"end\" from r")
def trim_range(spark, sf_dir):
    return _ranges(spark, sf_dir)


@query(f"with {_DELTAS} select event_id, value from d join r using (user_id) join events using (event_id) where e - s + 1 < 10 or t + 1 between s and e")
def trim_apply(spark, sf_dir):
    rows = align.indexed(events(spark, sf_dir), ["user_id"], ["ts", "event_id"])
    return motion.trimmed(rows, motion.trim_report(_ranges(spark, sf_dir)), ["user_id"], "idx").select("event_id", "value")


@query(
    f"""with {_DELTAS} select user_id, e - s + 1 trimmed_length, s start_removed, n_rows - 1 - e end_removed, n_rows < 2 or e - s + 1 < 10 as skipped,
 case when n_rows < 2 then 'too few rows' when e - s + 1 < 10 then 'trimmed length ' || (e - s + 1) || ' < min 10' when s = 0 and e = n_rows - 1 then 'no stationary frames detected' else 'trimmed' end as reason from r"""
)
def trim_report(spark, sf_dir):
    return motion.trim_report(_ranges(spark, sf_dir)).select("user_id", "trimmed_length", "start_removed", "end_removed", "skipped", "reason")


@query(f"with {_DELTAS} select count(*) total, count(*) filter (where e - s + 1 >= 10 and e - s + 1 < n_rows) trimmed, cast(coalesce(sum(n_rows - (e - s + 1)) filter (where e - s + 1 >= 10 and e - s + 1 < n_rows), 0) as bigint) frames_removed from r")
def trim_stats(spark, sf_dir):
    return motion.trim_stats(motion.trim_report(_ranges(spark, sf_dir)))


@query(f"with {_DELTAS}, p as (select distinct user_id, user_id % 7 - 2 st, user_id % 7 + 20 en from events) select event_id, t, round(delta, 6) as delta from p join d using (user_id) where t >= greatest(st, 0) and t < en")
def planned_deltas(spark, sf_dir):
    m = moved(spark, sf_dir).select("user_id", "event_id", "t", "delta")
    plan = m.select("user_id").distinct().select("user_id", (F.col("user_id") % 7 - 2).alias("start"), (F.col("user_id") % 7 + 20).alias("end"))
    return align.planned_rows(plan, m, ["user_id"]).select("event_id", "t", F.round("delta", 6).alias("delta"))


_SWEEP = [50.0, 100.0, 150.0, 200.0, *[round(x, 6) for x in motion.threshold_grid(1.0, 400.0)]]


@query(
    f"""with th as (select unnest({list(range(len(_SWEEP)))}) i, unnest({_SWEEP}) x), d as (select user_id, row_number() over (partition by user_id order by ts, event_id) - 2 t, abs(value - lag(value) over (partition by user_id order by ts, event_id)) delta from events),
a as (select i, x, user_id, count(*) n, min(case when delta > x then t end) f, max(case when delta > x then t end) l from d, th group by 1, 2, 3),
r as (select i, x, n, coalesce(least(l + 1, n - 1), n - 1) - coalesce(f, 0) + 1 as len from a)
select i, cast(x as double) as threshold, cast(sum(case when len >= 10 then n - len else n end) as bigint) total_removed, count(*) filter (where len < 10) episodes_dropped,
 round(coalesce(avg(len) filter (where len >= 10), 0), 6) mean_length, round(coalesce(quantile_cont(len, 0.5) filter (where len >= 10), 0), 6) median_length from r group by 1, 2"""
)
def threshold_sweep(spark, sf_dir):
    out = motion.threshold_sweep(moved(spark, sf_dir), ["user_id"], _SWEEP)
    return out.withColumn("mean_length", F.round("mean_length", 6)).withColumn("median_length", F.round("median_length", 6))


@query(
    f"""with {_DELTAS}, x as (select log10(delta) x from d where delta > 0), e as (select floor(min(x)) lo, ceil(max(x)) hi from x)
select cast(least(floor((x - lo) / ((hi - lo) / 99)), 98) as bigint) bin, count(*) as count from x, e group by 1"""
)
def delta_histogram(spark, sf_dir):
    return motion.delta_histogram(moved(spark, sf_dir)).withColumn("bin", F.col("bin").cast("bigint"))


@query(f"with {_DELTAS} select count(*) filter (where delta <= 150) below, count(*) filter (where delta > 150) above from d where delta > 0")
def threshold_counts(spark, sf_dir):
    return motion.below_and_above(moved(spark, sf_dir), 150.0)


@query(f"with {_DELTAS}, c as (select count(*) filter (where delta <= 150) below, count(*) filter (where delta > 150) above from d where delta > 0) select below, above, round(100.0::double * below / (below + above), 6) below_percent, round(100.0::double * above / (below + above), 6) above_percent from c")
def threshold_shares(spark, sf_dir):
    out = motion.threshold_shares(moved(spark, sf_dir), 150.0)
    return out.withColumns({c: F.round(c, 6) for c in ("below_percent", "above_percent")})


@query(
    f"""with {_DELTAS}, p as (select case when count(delta) = 0 then 0 else 100.0::double * count(*) filter (where delta <= 20) / count(delta) end as percent from d group by user_id)
select round(min(percent), 6) least, round(max(percent), 6) most, round(avg(percent), 6) mean, round(quantile_cont(percent, 0.5), 6) median from p"""
)
def stationary_figures(spark, sf_dir):
    out = motion.fraction_figures(motion.stationary_fraction(moved(spark, sf_dir), ["user_id"], 20.0))
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query(f"with {_DELTAS} select round(quantile_cont(delta, 0.05), 6) p05, round(quantile_cont(delta, 0.25), 6) p25, round(quantile_cont(delta, 0.5), 6) p50 from d where delta > 0")
def delta_percentiles(spark, sf_dir):
    out = motion.delta_percentiles(moved(spark, sf_dir))
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query(f"with {_DELTAS} select user_id, round(case when count(delta) = 0 then 0 else 100.0::double * count(*) filter (where delta <= 20) / count(delta) end, 6) percent from d group by user_id")
def stationary_fraction(spark, sf_dir):
    return motion.stationary_fraction(moved(spark, sf_dir), ["user_id"], 20.0).withColumn("percent", F.round("percent", 6))


# ---- vectors


@query("select vec_id, list_transform(embedding[1:3] || embedding[9:11], lambda x: round(x::double, 6)) positions, list_transform(embedding[4:7] || embedding[12:15], lambda x: round(x::double, 6)) orientations, round(embedding[8]::double, 6) jaw1, round(embedding[16]::double, 6) jaw2 from embeddings")
def state_slices(spark, sf_dir):
    v = F.col("v")
    each = lambda a: F.transform(a, lambda x: rounded(x.cast("double")))
    return vectors(spark, sf_dir).select("vec_id", each(F.concat(Q.position(v, 0), Q.position(v, 1))).alias("positions"), each(F.concat(Q.orientation(v, 0), Q.orientation(v, 1))).alias("orientations"), rounded(Q.jaw(v, 0)).alias("jaw1"), rounded(Q.jaw(v, 1)).alias("jaw2"))


def _q(c: str, i: int = 4) -> str:
    return f"list_transform({c}[{i}:{i + 3}], lambda x: x::double)"


@query(
    f"""with q as (select label, vec_id, {_q('embedding')} q from embeddings), l as (select label, vec_id, q, lag(q) over (partition by label order by vec_id) p from q),
d as (select *, list_sum([q[1] * p[1], q[2] * p[2], q[3] * p[3], q[4] * p[4]]) dot from l), s as (select *, sum(case when dot < 0 then 1 else 0 end) over (partition by label order by vec_id) flips from d)
select vec_id, cast(case when flips % 2 = 0 then 1 else -1 end as int) sign,
 round(sqrt(pow(q[1] - (case when dot < 0 then -1 else 1 end) * p[1], 2) + pow(q[2] - (case when dot < 0 then -1 else 1 end) * p[2], 2) + pow(q[3] - (case when dot < 0 then -1 else 1 end) * p[3], 2) + pow(q[4] - (case when dot < 0 then -1 else 1 end) * p[4], 2)), 6) delta from s"""
)
def quat_continuity(spark, sf_dir):
    rows = vectors(spark, sf_dir).select("label", "vec_id", Q.orientation(F.col("v"), 0).alias("q"), *[F.get("v", F.lit(3 + i)).cast("double").alias(f"q{i}") for i in range(4)])
    out = motion.quaternion_signs(rows, ["label"], ["vec_id"], "q")
    names = [f"q{i}" for i in range(4)]
    return motion.deltas(out, ["label"], ["vec_id"], names, [names]).select("vec_id", "sign", F.round("delta", 6).alias("delta"))


@query(
    f"""with q as (select vec_id, case when vec_id % 10 = 0 then [0.0::double, 0.0, 0.0, 0.0] else {_q('embedding')} end q from embeddings), n as (select *, sqrt(q[1] * q[1] + q[2] * q[2] + q[3] * q[3] + q[4] * q[4]) n from q)
select vec_id, case when n < 1e-8 then [0.0::double, 0.0, 0.0, 1.0] else list_transform(q, lambda x: round(x / n, 6)) end as q from n"""
)
def quat_normalize(spark, sf_dir):
    zero = F.array(*[F.lit(0.0)] * 4)
    q = F.when(F.col("vec_id") % 10 == 0, zero).otherwise(Q.orientation(F.col("v"), 0).cast("array<double>"))
    return vectors(spark, sf_dir).select("vec_id", F.transform(Q.normalize(q), lambda x: rounded(x)).alias("q"))


def _mul(a: str, b: str) -> str:
    return f"""[{a}[4]*{b}[1] + {a}[1]*{b}[4] + {a}[2]*{b}[3] - {a}[3]*{b}[2], {a}[4]*{b}[2] - {a}[1]*{b}[3] + {a}[2]*{b}[4] + {a}[3]*{b}[1],
 {a}[4]*{b}[3] + {a}[1]*{b}[2] - {a}[2]*{b}[1] + {a}[3]*{b}[4], {a}[4]*{b}[4] - {a}[1]*{b}[1] - {a}[2]*{b}[2] - {a}[3]*{b}[3]]"""


@query(f"with q as (select label, vec_id, {_q('embedding')} q from embeddings), l as (select vec_id, lag(q) over (partition by label order by vec_id) p, q from q) select vec_id, list_transform({_mul('p', 'q')}, lambda x: round(x, 6)) as product from l where p is not null")
def quat_multiply(spark, sf_dir):
    from pyspark.sql import Window

    rows = vectors(spark, sf_dir).select("label", "vec_id", Q.orientation(F.col("v"), 0).alias("q"))
    rows = rows.withColumn("p", F.lag("q").over(Window.partitionBy("label").orderBy("vec_id"))).where("p IS NOT NULL")
    return rows.select("vec_id", F.transform(Q.multiply(F.col("p"), F.col("q")), lambda x: rounded(x)).alias("product"))


def _unit(name: str, of: str, i: int) -> str:
    return f"list_transform({of}[{i}:{i + 3}], lambda x: x / sqrt({of}[{i}]*{of}[{i}] + {of}[{i + 1}]*{of}[{i + 1}] + {of}[{i + 2}]*{of}[{i + 2}] + {of}[{i + 3}]*{of}[{i + 3}])) {name}"


def _hybrid_sql() -> str:
    sql = "with v as (select label, vec_id, list_transform(embedding[1:16], lambda x: x::double) a from embeddings), l as (select *, coalesce(lead(a) over (partition by label order by vec_id), a) b from v)"
    sql += f", u as (select *, {_unit('q1', 'a', 4)}, {_unit('r1', 'b', 4)}, {_unit('q2', 'a', 12)}, {_unit('r2', 'b', 12)} from l)"
    fixed = lambda q, r: f"case when {q}[1]*{r}[1] + {q}[2]*{r}[2] + {q}[3]*{r}[3] + {q}[4]*{r}[4] < 0 then list_transform({r}, lambda x: -x) else {r} end"
    sql += f", f as (select *, {fixed('q1', 'r1')} s1, {fixed('q2', 'r2')} s2, [-q1[1], -q1[2], -q1[3], q1[4]] i1, [-q2[1], -q2[2], -q2[3], q2[4]] i2 from u), m as (select *, {_mul('i1', 's1')} m1, {_mul('i2', 's2')} m2 from f)"
    unit = lambda m: f"list_transform({m}, lambda x: round(x / sqrt({m}[1]*{m}[1] + {m}[2]*{m}[2] + {m}[3]*{m}[3] + {m}[4]*{m}[4]), 6) + 0.0)"
    step = lambda i: f"[round(b[{i}] - a[{i}], 6), round(b[{i + 1}] - a[{i + 1}], 6), round(b[{i + 2}] - a[{i + 2}], 6)]"
    return sql + f" select vec_id, {step(1)} || {unit('m1')} || [round(a[8], 6)] || {step(9)} || {unit('m2')} || [round(a[16], 6)] as relative from m"


def _relative(rows: DataFrame) -> DataFrame:
    return assemble.with_relative_actions(rows, ["label"], ["vec_id"], "v", "relative")


@query(_hybrid_sql())
def hybrid_relative_action(spark, sf_dir):
    turned = lambda i: (i % Q.ARM).between(3, 6)
    each = F.transform("relative", lambda x, i: F.when(turned(i), F.round(x, 6) + F.lit(0.0)).otherwise(rounded(x)))
    return _relative(vectors(spark, sf_dir)).select("vec_id", each.alias("relative"))


@query(
    """select label as episode_index, row_number() over (partition by label order by vec_id) - 1 frame_index, round((row_number() over (partition by label order by vec_id) - 1) * (1.0::double / 30), 6) as timestamp,
 round(list_sum(list_transform(embedding[1:16], lambda x: x::double)), 6) state_sum, round(embedding[8]::double, 6) jaw from embeddings"""
)
def episode_rows(spark, sf_dir):
    v = _relative(vectors(spark, sf_dir)).withColumn("state", F.col("v").cast("array<float>"))
    rows = assemble.assembled(v, "label", ["vec_id"], "state", "v", "relative", fps=30)
    total = F.aggregate("observation_state", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return rows.select("episode_index", "frame_index", F.round("timestamp", 6).alias("timestamp"), rounded(total).alias("state_sum"), rounded(F.get("action_hybrid_relative", F.lit(7)).cast("double")).alias("jaw"))


@query("select label, round(avg(embedding[1]::double), 6) x, round(avg(embedding[2]::double), 6) y, round(avg(embedding[3]::double), 6) z, round(greatest(max(embedding[1]) - min(embedding[1]), max(embedding[2]) - min(embedding[2]), max(embedding[3]) - min(embedding[3]))::double, 5) span from embeddings group by label")
def trajectory_bounds(spark, sf_dir):
    return assemble.bounds(vectors(spark, sf_dir), ["label"], "v").select("label", *[rounded(F.col(c)).alias(c) for c in "xyz"], F.round("span", 5).alias("span"))


_COLUMNS = tuple(f"psm{a}_pose.position.{k}" for a in (1, 2) for k in "xyz")


@query("select vec_id, list_transform(embedding[1:6], lambda x: round(x::double, 6)) as flat, list_transform(embedding[1:2], lambda x: round(x::double, 6)) as listed from embeddings")
def flat_vectors(spark, sf_dir):
    v = vectors(spark, sf_dir)
    flat = v.select("vec_id", *[F.get("v", F.lit(i)).alias(c) for i, c in enumerate(_COLUMNS)], F.slice("v", 1, 2).alias("listed"))
    each = lambda c: F.transform(c, lambda x: rounded(x.cast("double")))
    return flat.select("vec_id", each(assemble.vector(flat, "none", (*_COLUMNS, "lost"))).alias("flat"), each(assemble.vector(flat, "listed", _COLUMNS)).alias("listed"))


@query("with e as (select vec_id, label, row_number() over (partition by label order by vec_id) - 1 i from embeddings), s as (select label, vec_id, row_number() over (partition by label order by vec_id) - 1 i from embeddings where vec_id % 3 <> 0) select e.vec_id, s.vec_id as other from e join s using (label, i)")
def zipped_streams(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("label", "vec_id")
    parts = [align.indexed(x, ["label"], ["vec_id"], "frame_index") for x in (e, e.where("vec_id % 3 <> 0"))]
    return assemble.zipped([parts[0], parts[1].withColumnRenamed("vec_id", "other")], ["label"]).select("vec_id", "other")


# ---- alignment

_ALIGN = """ref as (select user_id, ts, row_number() over (partition by user_id order by ts, event_id) - 1 i, count(*) over (partition by user_id) n from events),
src as (select user_id, ts, count(*) over (partition by user_id) m from events where value > 10),
plan as (select distinct user_id, user_id % 20 st, user_id % 20 + 15 en from events),
b as (select p.user_id, r1.ts t1, r2.ts t2 from plan p join ref r1 on r1.user_id = p.user_id and r1.i = greatest(0, least(p.st, r1.n - 1)) join ref r2 on r2.user_id = p.user_id and r2.i = greatest(0, least(p.en, r2.n - 1))),
f as (select b.user_id, cast(greatest(0, least(sum(case when src.ts < b.t1 then 1 else 0 end), max(m) - 1)) as bigint) s, cast(greatest(0, least(sum(case when src.ts <= b.t2 then 1 else 0 end) - 1, max(m) - 1)) as bigint) e from b join src on src.user_id = b.user_id group by b.user_id)"""


def _aligned(spark, sf_dir):
    ev = events(spark, sf_dir).select("user_id", "event_id", "t", "value")
    ref, src = (align.indexed(x, ["user_id"], ["t", "event_id"]) for x in (ev, ev.where("value > 10")))
    plan = ev.select("user_id").distinct().select("user_id", (F.col("user_id") % 20).alias("start"), (F.col("user_id") % 20 + 15).alias("end"))
    return align.align_ranges(plan, ref, src, ["user_id"], [], ts="t"), ref, src


@query(f"with {_ALIGN} select user_id, s as src_start, e as src_end, e < s as empty from f")
def range_align(spark, sf_dir):
    return _aligned(spark, sf_dir)[0].select("user_id", "src_start", "src_end", "empty")


@query(
    f"""with {_ALIGN}, k as (select user_id, ts, row_number() over (partition by user_id order by ts, event_id) - 1 i, count(*) over (partition by user_id) m from events where value > 10),
c as (select f.user_id, k1.ts t1, k2.ts t2 from f join k k1 on k1.user_id = f.user_id and k1.i = greatest(0, least(f.s, k1.m - 1)) join k k2 on k2.user_id = f.user_id and k2.i = greatest(0, least(f.e, k2.m - 1)))
select c.user_id, cast(greatest(0, least(sum(case when ref.ts < c.t1 then 1 else 0 end), max(n) - 1)) as bigint) ref_start, cast(greatest(0, least(sum(case when ref.ts <= c.t2 then 1 else 0 end) - 1, max(n) - 1)) as bigint) ref_end from c join ref using (user_id) group by c.user_id"""
)
def range_align_back(spark, sf_dir):
    out, ref, src = _aligned(spark, sf_dir)
    plan = out.select("user_id", F.col("src_start").alias("start"), F.col("src_end").alias("end"))
    back = align.align_ranges(plan, src, ref, ["user_id"], [], ts="t")
    return back.select("user_id", F.col("src_start").alias("ref_start"), F.col("src_end").alias("ref_end"))


# ---- datasets, samples, reports


@query(
    """with u as (select count(distinct user_id) n, count(distinct user_id) filter (where user_id % 4 <> 0) p, count(distinct user_id) filter (where user_id % 4 = 0) r from events)
select '0:' || floor(0.8 * n)::bigint as train, floor(0.8 * n)::bigint || ':' || (floor(0.8 * n)::bigint + floor(0.1 * n)::bigint) as val, (floor(0.8 * n)::bigint + floor(0.1 * n)::bigint) || ':' || n as test, '0:' || p as perfect, p || ':' || (p + r) as recovery from u"""
)
def dataset_splits(spark, sf_dir):
    u = events(spark, sf_dir).select("user_id").distinct()
    counts = u.agg(F.count("*").alias("n"), F.count_if(F.col("user_id") % 4 != 0).alias("p"), F.count_if(F.col("user_id") % 4 == 0).alias("r"))
    return counts.select(*planning.splits(F.col("n"), F.col("p"), F.col("r")))


@query(
    """with r as (select event_type, event_id, row_number() over (partition by event_type order by event_id) - 1 r, count(*) over (partition by event_type) n from events)
select event_id, 'step' as kind from r where r % greatest(1, n // 10) = 0 union all select event_id, 'even' from r where list_contains([floor(i * (n - 1) / 5)::bigint for i in [0, 1, 2, 3, 4, 5]], r)"""
)
def systematic_sample(spark, sf_dir):
    ev = events(spark, sf_dir).select("event_type", "event_id")
    part = F.floor(F.col("event_id") / 4096)  # five event types hold all rows: each is cut where its order allows
    a = planning.every_kth(ev, ["event_type"], ["event_id"], bucket=part).select("event_id", F.lit("step").alias("kind"))
    return a.unionByName(planning.evenly_spaced(ev, ["event_type"], ["event_id"], bucket=part).select("event_id", F.lit("even").alias("kind")))


@query("select o_orderkey, o_orderstatus as run, row_number() over (partition by o_orderstatus order by o_orderdate, o_orderkey) - 1 as position from orders where o_orderstatus in ('F', 'O', 'P')")
def run_concat(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    runs = [(s, o.where(F.col("o_orderstatus") == s)) for s in ("F", "O", "P")]
    return planning.merged_runs(runs, ["o_orderdate", "o_orderkey"], F.date_trunc("month", "o_orderdate")).select("o_orderkey", "run", "position")


@query(
    f"""with {_DELTAS} select count(*) filter (where n_rows >= 2 and e - s + 1 >= 10) processed, count(*) filter (where n_rows >= 2 and e - s + 1 < 10) skipped, count(*) filter (where n_rows < 2) errors,
 cast(coalesce(sum(e - s + 1) filter (where n_rows >= 2 and e - s + 1 >= 10), 0) as bigint) frames, cast(sum(n_rows) as bigint) as rows from r"""
)
def pipeline_report(spark, sf_dir):
    return motion.pipeline_figures(motion.trim_report(_ranges(spark, sf_dir)))


@query("select p_retailprice as threshold from (select distinct p_retailprice from part) order by abs(p_retailprice - 1500.3), p_retailprice limit 1")
def nearest_threshold(spark, sf_dir):
    return motion.nearest_threshold(table(spark, sf_dir, "part").select(F.col("p_retailprice").alias("threshold")).distinct(), 1500.3)


@query("with n as (select user_id, count(*) n from events where user_id % 4 <> 0 group by 1) select user_id, n as n_rows, 'read' as reason from n union all select distinct user_id, 0, 'missing CSV' from events where user_id % 4 = 0")
def missing_samples(spark, sf_dir):
    ev = events(spark, sf_dir)
    read = ev.where("user_id % 4 <> 0").groupBy("user_id").agg(F.count("*").alias("n_rows")).withColumns({"skipped": F.lit(False), "reason": F.lit("read")})
    return motion.with_missing(read, ev.select("user_id").distinct(), ["user_id"]).select("user_id", "n_rows", "reason")


@query(
    """select o_orderkey, round(avg(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey rows between 4 preceding and current row) *
 (count(*) over (partition by o_custkey) - row_number() over (partition by o_custkey order by o_orderdate, o_orderkey)), 4) eta from orders"""
)
def moving_eta(spark, sf_dir):
    from tracewright.operators.assemble import remaining_time

    return remaining_time(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice").select("o_orderkey", F.round("eta", 4).alias("eta"))


@query("select vec_id, printf('data/chunk-%03d/episode_%06d.parquet', vec_id // 1000, vec_id) as path, label from embeddings where vec_id in (7, 123, 480)")
def episode_lookup(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").where(F.col("vec_id").isin(7, 123, 480))
    return e.select("vec_id", N.chunk_path(F.col("vec_id")).alias("path"), "label")


# ---- quality rules


@query("select label, count(*) filter (where vec_id % 50 in (0, 1)) as bad from embeddings group by label")
def nan_inf(spark, sf_dir):
    k = F.col("vec_id") % 50
    v = vectors(spark, sf_dir).select("label", F.transform("v", lambda x: F.when(k == 0, F.lit(float("nan"))).when(k == 1, F.lit(float("-inf"))).otherwise(x.cast("double"))).alias("v"))
    return v.groupBy("label").agg(F.count_if(quality.not_finite(F.col("v"))).alias("bad"))


_NORM = "abs(sqrt(list_sum(list_transform(embedding[{a}:{b}], lambda x: x::double * x::double))) - 1) > 0.05"


@query(f"select label, count(*) filter (where {_NORM.format(a=4, b=7)}) arm1, count(*) filter (where {_NORM.format(a=12, b=15)}) arm2, round(100.0::double * count(*) filter (where {_NORM.format(a=4, b=7)}) / count(*), 6) percent1 from embeddings group by label")
def quat_norm(spark, sf_dir):
    v = F.col("v")
    off = F.count_if(quality.norm_off(v, 0))
    return vectors(spark, sf_dir).groupBy("label").agg(off.alias("arm1"), F.count_if(quality.norm_off(v, 1)).alias("arm2"), F.round(100.0 * off / F.count("*"), 6).alias("percent1"))


@query("select label, count(*) filter (where embedding[8]::double * 10 < -0.7::double or embedding[8]::double * 10 > 1.5::double) arm1, count(*) filter (where embedding[16]::double * 10 < -0.7::double or embedding[16]::double * 10 > 1.5::double) arm2 from embeddings group by label")
def jaw_bounds(spark, sf_dir):
    v = vectors(spark, sf_dir).withColumn("v", F.transform("v", lambda x: x.cast("double") * 10))
    return v.groupBy("label").agg(F.count_if(quality.jaw_off(F.col("v"), 0)).alias("arm1"), F.count_if(quality.jaw_off(F.col("v"), 1)).alias("arm2"))


@query("with s as (select user_id, epoch_us(ts) // 60000000 - lag(epoch_us(ts) // 60000000) over (partition by user_id order by ts, event_id) d from events) select user_id, count(*) filter (where d <= 0) violations, count(*) filter (where d <= 0) = 0 as ok from s group by user_id")
def ts_monotonic(spark, sf_dir):
    ev = events(spark, sf_dir).withColumn("minute", F.floor(F.col("t") / 60_000_000))
    return quality.monotonic(ev, ["user_id"], ["ts", "event_id"], "minute")


@query(f"with s as (select user_id, epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id order by ts, event_id) d from events) select user_id, max(d) max_gap, coalesce(max(d) > {2 * _DAY}, false) as gap from s group by user_id")
def ts_gap(spark, sf_dir):
    return quality.gaps(events(spark, sf_dir), ["user_id"], ["ts", "event_id"], "t", 2 * _DAY)


@query(
    """with f as (select *, case when conv_id % 3 = 0 then -turn else turn end as place, case when conv_id % 5 = 0 and turn = 1 then -1 else conv_id end as episode_index from conversations),
r as (select *, row_number() over (partition by conv_id order by place) - 1 r from f)
select conv_id, count(*) n, count(*) filter (where turn is distinct from r) = 0 and count(distinct episode_index) = 1 as ok from r group by conv_id"""
)
def index_integrity(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn("episode_index", F.when(F.expr("conv_id % 5 = 0 AND turn = 1"), -1).otherwise(F.col("conv_id")))
    place = F.when(F.col("conv_id") % 3 == 0, -F.col("turn")).otherwise(F.col("turn"))  # every third file is written backwards
    return quality.index_integrity(rows, ["conv_id"], "turn", [place], "episode_index")


@query("with e as (select unnest(embedding[1:16]) v, unnest(range(16)) dim from embeddings), d as (select dim, stddev_pop(case when dim >= 12 then 1 else v::double end) std from e group by 1) select count(*) filter (where std < 1e-8) still, round(avg(std), 6) mean_std from d")
def still_dimensions(spark, sf_dir):
    v = vectors(spark, sf_dir).withColumn("v", F.transform("v", lambda x, i: F.when(i >= 12, F.lit(1.0)).otherwise(x.cast("double"))))
    return validators.still_dimensions(v, "v").withColumn("mean_std", F.round("mean_std", 6))


@query("with e as (select label, unnest(embedding[1:16]) v, unnest(range(16)) dim from embeddings) select label, cast(dim as int) dim, round(stddev_pop(v::double), 6) std from e group by 1, 2")
def action_std(spark, sf_dir):
    return quality.deviations(vectors(spark, sf_dir), ["label"], "v").withColumn("std", F.round("std", 6))


@query("with n as (select user_id, count(*) n from events group by 1) select min(n) shortest, max(n) longest, round(avg(n), 6) mean, min(n) < 10 as warned from n")
def episode_lengths(spark, sf_dir):
    n = events(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("n"))
    return quality.length_figures(n).withColumn("mean", F.round("mean", 6))


def _infos(spark, sf_dir):
    """An info document for each nation: its key decides what is there."""
    k = F.col("n_nationkey")
    entry = lambda name, dtype, *shape: F.struct(F.lit(name).alias("key"), F.struct(F.lit(dtype).alias("dtype"), F.array(*shape).cast("array<int>").alias("shape")).alias("value"))
    some = F.array(
        entry("observation.state", "float32", F.lit(16)),
        F.when(k % 2 == 0, entry("action", "float32", F.lit(16))),
        F.when(k % 3 != 0, entry("observation.images.left", "video", k * 40, F.lit(640), F.lit(3))),
        F.when(k % 5 == 0, entry("observation.meta.tool", "string", F.lit(1))),
    )
    names = lambda *c: F.map_from_entries(F.filter(F.array(*c), lambda x: x.isNotNull()))
    split = lambda name, when: F.when(when, F.struct(F.lit(name).alias("key"), F.lit("0:1").alias("value")))
    parts = names(split("train", F.lit(True)), split("val", k % 2 == 0), split("test", k % 3 == 0), split("recovery", k % 5 == 0), split("failure", k % 7 == 0))
    one = F.to_json(F.struct(F.lit(30).alias("fps"), F.lit("dvrk").alias("robot_type"), parts.alias("splits"), F.map_from_entries(F.filter(some, lambda x: x.isNotNull())).alias("features"), F.when(k % 4 == 0, F.lit(0.02)).alias("tolerance_s")))
    return table(spark, sf_dir, "nation").select(k, F.when(k == 24, F.lit("{broken")).otherwise(one).alias("value"))


@query(
    """with i as (select n_nationkey k from nation where n_nationkey <> 24), f as (
select 'features' category, 'SUCCESS' as level, 'observation.state is there' message from i union all select 'features', case when k % 2 = 0 then 'SUCCESS' else 'ERROR' end, case when k % 2 = 0 then 'action is there' else 'action is missing' end from i
union all select 'features', 'WARNING', 'no feature starts with observation.images.' from i where k % 3 = 0 union all select 'features', case when k % 5 = 0 then 'SUCCESS' else 'INFO' end, case when k % 5 = 0 then 'domain metadata: observation.meta.tool' else 'no domain metadata' end from i
union all select 'images', 'SUCCESS', 'observation.images.left is video' from i where k % 3 <> 0 union all select 'images', 'WARNING', 'observation.images.left is ' || (k * 40) || 'x640' from i where k % 3 <> 0 and k * 40 < 480)
select category, level, message, count(*) n from f group by all"""
)
def feature_rules(spark, sf_dir):
    return validators.features(_infos(spark, sf_dir)).groupBy("category", "level", "message").agg(F.count("*").alias("n"))


@query(
    """with i as (select n_nationkey k from nation where n_nationkey <> 24), f as (select case when k % 2 = 0 then 'SUCCESS' else 'WARNING' end as level, case when k % 2 = 0 then 'split val defined' else 'split val missing' end message from i
union all select case when k % 3 = 0 then 'SUCCESS' else 'WARNING' end, case when k % 3 = 0 then 'split test defined' else 'split test missing' end from i union all select 'SUCCESS', 'split train defined' from i
union all select case when k % 5 = 0 then 'SUCCESS' else 'INFO' end, case when k % 5 = 0 then 'split recovery defined' else 'split recovery would add robustness' end from i union all select 'INFO', 'split failure defined' from i where k % 7 = 0)
select 'splits' category, level, message, count(*) n from f group by all"""
)
def split_rules(spark, sf_dir):
    return validators.splits(_infos(spark, sf_dir)).groupBy("category", "level", "message").agg(F.count("*").alias("n"))


def _tree(spark, sf_dir):
    """A dataset's listing: a chunk for each region, an episode file for each nation, and no videos or README."""
    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    chunk = lambda c: F.concat(F.lit("data/chunk-"), F.lpad(F.col(c).cast("string"), 3, "0"))
    fixed = spark.createDataFrame([("meta", True), ("data", True), *[(f"meta/{f}", False) for f in ("info.json", "episodes.jsonl")]], "path string, is_dir boolean")
    files = n.select(F.concat(chunk("n_regionkey"), F.format_string("/episode_%06d.parquet", "n_nationkey")).alias("path"), F.lit(False).alias("is_dir"))
    return fixed.unionByName(r.select(chunk("r_regionkey").alias("path"), F.lit(True).alias("is_dir"))).unionByName(files)


@query(
    """select 'structure' category, 'ERROR' as level, 'videos is missing' message union all select 'structure', 'SUCCESS', 'meta is there' union all select 'structure', 'SUCCESS', 'data is there'
union all select 'structure', 'SUCCESS', (select count(*) from nation) || ' episode files in ' || (select count(*) from region) || ' chunks'
union all select 'metadata', 'SUCCESS', 'info.json is there' union all select 'metadata', 'SUCCESS', 'episodes.jsonl is there' union all select 'metadata', 'ERROR', 'tasks.jsonl is missing' union all select 'metadata', 'ERROR', 'README.md is missing'"""
)
def structure_rules(spark, sf_dir):
    tree = _tree(spark, sf_dir)
    return validators.structure(tree).unionByName(validators.metadata_files(tree))


@query("select 'tasks' category, 'SUCCESS' as level, count(distinct p_type) || ' tasks' message from part union all select 'tasks', 'SUCCESS', count(distinct p_type) || ' recovery tasks' from part where p_partkey % 2 = 0 and contains(lower(p_type), 'recovery') having count(*) > 0")
def task_rules(spark, sf_dir):
    line = F.to_json(F.struct(F.col("p_partkey").cast("int").alias("episode_index"), F.array("p_type").alias("tasks")))
    return validators.tasks(table(spark, sf_dir, "part").select(line.alias("value")))


@query(
    """with f as (select 'structure' category, 1 errors, 0 warnings union all select 'metadata', 2, 0 union all select 'splits', 0, (select count(*) filter (where n_nationkey % 2 <> 0) + count(*) filter (where n_nationkey % 3 <> 0) from nation where n_nationkey <> 24)
union all select 'features', (select count(*) from nation where n_nationkey % 2 <> 0 and n_nationkey <> 24), (select count(*) from nation where n_nationkey % 3 = 0 and n_nationkey <> 24) union all select 'images', 0, (select count(*) from nation where n_nationkey % 3 <> 0 and n_nationkey * 40 < 480)
union all select 'tasks', 0, 0 union all select 'synchronization', 0, (select count(*) from documents where not (contains(lower(text), 'synchron') or contains(lower(text), 'timestamp')))
union all select 'columns', 0, 3 union all select 'variation', 0, 0)
select category, cast(errors as bigint) errors, cast(warnings as bigint) warnings, errors = 0 as compliant from f"""
)
def dataset_findings(spark, sf_dir):
    lines = table(spark, sf_dir, "part").select(F.to_json(F.struct(F.col("p_partkey").cast("int").alias("episode_index"), F.array("p_type").alias("tasks"))).alias("value"))
    readme = table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    found = validators.all_findings(_tree(spark, sf_dir), _infos(spark, sf_dir), lines, readme, vectors(spark, sf_dir), "v")
    return quality.roll_up(found).drop("messages")


@query(
    """with f as (select 's' || s_suppkey as name, ['float32', 'video', 'string'][s_suppkey % 3 + 1] dtype, cast(s_suppkey % 5 as int) dim from supplier where s_suppkey % 11 <> 0),
e as (select 's' || s_suppkey as name, case when s_suppkey % 4 = 0 then 'float64' else ['float32', 'video', 'string'][s_suppkey % 3 + 1] end dtype, cast(case when s_suppkey % 6 = 1 then 7 else s_suppkey % 5 end as int) dim from supplier where s_suppkey % 13 <> 0)
select coalesce(f.name, e.name) as name, case when f.name is null then 'ERROR' when e.name is null then 'INFO' when f.dtype <> e.dtype or f.dim <> e.dim then 'ERROR' else 'SUCCESS' end as level,
 case when f.name is null then 'missing' when e.name is null then 'extra' when f.dtype <> e.dtype then 'dtype ' || f.dtype || ' instead of ' || e.dtype when f.dim <> e.dim then 'shape ' || f.dim || ' instead of ' || e.dim else 'ok' end as message
from f full join e on f.name = e.name"""
)
def feature_schema(spark, sf_dir):
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select(k, F.concat(F.lit("s"), k.cast("string")).alias("name"), F.element_at(F.array(*map(F.lit, ("float32", "video", "string"))), (k % 3 + 1).cast("int")).alias("dtype"), (k % 5).cast("int").alias("dim"))
    expected = s.where(k % 13 != 0).select("name", F.when(k % 4 == 0, F.lit("float64")).otherwise(F.col("dtype")).alias("dtype"), F.when(k % 6 == 1, F.lit(7)).otherwise(F.col("dim")).alias("dim"))
    return quality.feature_findings(s.where(k % 11 != 0).drop("s_suppkey"), expected)


@query(
    """select o_orderkey as id, case when o_orderkey % 11 = 0 then 'ERROR' when o_orderkey % 40 >= 20 and o_orderkey % 3 <> 0 and o_orderkey % 2 = 0 and o_orderkey % 5 = 0 then 'SUCCESS' else 'WARNING' end as level,
 case when o_orderkey % 11 = 0 then 'unreadable' else concat_ws('; ', case when o_orderkey % 40 < 20 then 'fps below 20' end, case when o_orderkey % 3 = 0 then 'robot_type is not dvrk' end, case when o_orderkey % 5 <> 0 then 'split test missing' end, case when o_orderkey % 2 <> 0 then 'split val missing' end) end as message from orders"""
)
def info_rules(spark, sf_dir):
    from tracewright.sources.metadata import info_findings

    k = F.col("o_orderkey")
    split = lambda name, when: F.when(when, F.struct(F.lit(name).alias("key"), F.lit("0:1").alias("value")))
    parts = F.map_from_entries(F.filter(F.array(split("train", F.lit(True)), split("val", k % 2 == 0), split("test", k % 5 == 0)), lambda x: x.isNotNull()))
    one = F.to_json(F.struct((k % 40).alias("fps"), F.when(k % 3 == 0, F.lit("other")).otherwise(F.lit("dvrk")).alias("robot_type"), parts.alias("splits")))
    return info_findings(table(spark, sf_dir, "orders").select(k.alias("id"), F.when(k % 11 == 0, F.lit("{broken")).otherwise(one).alias("value")))


@query(
    """select c_custkey as line, c_custkey % 9 <> 1 as readable, cast(case when c_custkey % 9 <> 1 then c_custkey * 2 end as int) as episode_index, cast(case when c_custkey % 9 not in (1, 3) then c_custkey % 50 end as int) as length,
 case c_custkey % 9 when 1 then '' when 2 then 'cut' when 3 then 'lift' else 'cut|' || c_mktsegment end as tasks from customer where c_custkey % 9 <> 0"""
)
def jsonl_parse(spark, sf_dir):
    from tracewright.sources.metadata import parsed_lines

    k, segment = F.col("c_custkey"), F.col("c_mktsegment")
    index, length = (k * 2).cast("int").alias("episode_index"), (k % 50).cast("int").alias("length")
    value = (
        F.when(k % 9 == 0, F.lit("  ")).when(k % 9 == 1, F.lit("{oops")).when(k % 9 == 2, F.to_json(F.struct(index, F.lit("cut").alias("tasks"), length)))
        .when(k % 9 == 3, F.to_json(F.struct(index, F.lit("lift").alias("task")))).otherwise(F.to_json(F.struct(index, F.array(F.lit("cut"), segment).alias("tasks"), length)))
    )
    lines = parsed_lines(table(spark, sf_dir, "customer").select(k.alias("line"), value.alias("value")))
    return lines.select("line", "readable", "episode_index", "length", F.array_join("task_list", "|").alias("tasks"))


@query("select 'lines per order' as \"check\", (select count(*) * 4 from orders) expected, (select count(*) from lineitem) found, (select count(*) * 4 from orders) = (select count(*) from lineitem) ok")
def count_reconcile(spark, sf_dir):
    return quality.reconciled(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), "lines per order", 4)


@query(
    """with o as (select o_orderkey k, 1 + o_orderkey % 7 as len, case when o_orderkey % 29 = 0 then 2 else 1 end as lines from orders where o_orderkey % 10 <> 0),
d as (select l_orderkey k, count(*) n from lineitem where l_orderkey % 13 <> 0 group by 1),
v as (select l_orderkey k, l_returnflag c, count(*) n, min(l_linenumber) f from lineitem where l_orderkey % 11 <> 0 group by 1, 2),
e as (select coalesce(o.k, d.k) k, len, lines, n from o full join d on o.k = d.k), w as (select coalesce(e.k, x.k) k, len, lines, n from e full join (select distinct k from v) x on e.k = x.k),
a as (select w.*, va.n na, va.f fa, vr.n nr, vr.f fr, vn.n nn, coalesce(len, w.n) want from w left join v va on va.k = w.k and va.c = 'A' left join v vr on vr.k = w.k and vr.c = 'R' left join v vn on vn.k = w.k and vn.c = 'N')
select k as episode_index, 'ERROR' as level, 'no metadata line' as message from a where lines is null union all select k, 'ERROR', lines || ' metadata lines' from a where lines > 1
union all select k, 'ERROR', 'no data file' from a where n is null union all select k, 'ERROR', n || ' rows instead of ' || len from a where n <> len
union all select k, 'WARNING', 'no video of A' from a where na is null union all select k, 'WARNING', na || ' videos of A' from a where na > 1 union all select k, 'WARNING', 'video of A has ' || fa || ' frames instead of ' || want from a where fa <> want
union all select k, 'WARNING', 'no video of R' from a where nr is null union all select k, 'WARNING', nr || ' videos of R' from a where nr > 1 union all select k, 'WARNING', 'video of R has ' || fr || ' frames instead of ' || want from a where fr <> want
union all select k, 'WARNING', 'video N is not expected' from a where nn is not null"""
)
def episode_reconciliation(spark, sf_dir):
    k = F.col("o_orderkey")
    lines = table(spark, sf_dir, "orders").where(k % 10 != 0).select(k.alias("episode_index"), (1 + k % 7).alias("length"), F.explode(F.array_repeat(F.lit(0), F.when(k % 29 == 0, 2).otherwise(1))).alias("_")).drop("_")
    items = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "episode_index")
    videos = items.where("episode_index % 11 <> 0").select("episode_index", F.col("l_returnflag").alias("camera"), F.col("l_linenumber").alias("frames"))
    return quality.reconciled_episodes(lines, items.where("episode_index % 13 <> 0"), videos, ["A", "R"])


_FINDINGS = """
with r as (select label e, row_number() over (partition by label order by vec_id) - 1 i, embedding[1:16] v, vec_id from embeddings),
t as (select e, i, case when vec_id % 40 = 0 then -1 else 0 end + vec_id % 1000 / 100.0 as s, v from r), d as (select *, s - lag(s) over (partition by e order by i) step from t),
g as (select e, count(*) n, count(*) filter (where step <= 0) back, coalesce(max(step) > 2 / 30.0, false) gap from d group by e),
f as (select 'values' category, 1 k, count(*) filter (where abs(sqrt(list_sum(list_transform(v[4:7], lambda x: x::double * x::double))) - 1) > 0.05) n, 'WARNING' as level, 'rows of v with an orientation of arm 1 that is not of length 1' what from r
union all select 'values', 2, count(*) filter (where abs(sqrt(list_sum(list_transform(v[12:15], lambda x: x::double * x::double))) - 1) > 0.05), 'WARNING', 'rows of v with an orientation of arm 2 that is not of length 1' from r
union all select 'values', 3, count(*) filter (where v[8]::double < -0.7 or v[8]::double > 1.5), 'WARNING', 'rows of v with a jaw of arm 1 out of bounds' from r
union all select 'values', 4, count(*) filter (where v[16]::double < -0.7 or v[16]::double > 1.5), 'WARNING', 'rows of v with a jaw of arm 2 out of bounds' from r
union all select 'values', 0, 0, 'ERROR', 'rows of v with a value that is not finite'
union all select 'times', 5, count(*) filter (where back > 0), 'ERROR', 'episodes whose time does not rise' from g union all select 'times', 6, count(*) filter (where gap), 'WARNING', 'episodes with a long step' from g
union all select 'times', 7, 0, 'ERROR', 'episodes whose index does not count from 0' union all select 'times', 8, count(*) filter (where n < 10), 'WARNING', 'episodes of fewer than 10 rows' from g)
select category, case when n > 0 then level else 'SUCCESS' end as level, case when n > 0 then n || ' ' || what else 'no ' || what end as message from f"""


@query(_FINDINGS)
def row_findings(spark, sf_dir):
    v = vectors(spark, sf_dir)
    rows = align.indexed(v, ["label"], ["vec_id"], "frame_index").withColumnRenamed("label", "episode_index")
    rows = rows.withColumn("timestamp", F.when(F.col("vec_id") % 40 == 0, -1).otherwise(0) + F.col("vec_id") % 1000 / 100.0)
    rows = rows.withColumn("v", F.col("v").cast("array<double>"))
    return validators.values(rows, ["v"]).unionByName(validators.times(rows, 30.0))


@query("select p_brand, string_agg(distinct p_type, ', ' order by p_type) as tasks, count(distinct p_type) n_tasks from part group by p_brand")
def task_labels(spark, sf_dir):
    from tracewright.sources.metadata import distinct_tasks

    p = table(spark, sf_dir, "part")
    return distinct_tasks(p.select("p_brand", F.array("p_type", "p_type").alias("tasks")), ["p_brand"])


@query("select lang, count(*) n, count(*) filter (where contains(lower(text), 'license') or contains(lower(text), 'token')) hits from documents group by lang")
def keyword_check(spark, sf_dir):
    return quality.keyword_share(table(spark, sf_dir, "documents"), ["license", "token"], ["lang"])


@query(
    """with f as (select doc_id seq, case when toxic = 1 then 'ERROR' when quality = 0 then 'WARNING' else 'SUCCESS' end as level, 'group' || (doc_id % 5) as category, 'doc ' || doc_id as message from labels),
r as (select *, row_number() over (partition by category order by case level when 'ERROR' then 0 when 'WARNING' then 1 else 2 end, seq) k from f)
select category, count(*) filter (where level = 'ERROR') errors, count(*) filter (where level = 'WARNING') warnings, count(*) filter (where level = 'ERROR') = 0 compliant, string_agg(message, '|' order by k) filter (where k <= 3) messages from r group by category"""
)
def findings_rollup(spark, sf_dir):
    l = table(spark, sf_dir, "labels")  # noqa: E741
    level = F.when(F.col("toxic") == 1, F.lit("ERROR")).when(F.col("quality") == 0, F.lit("WARNING")).otherwise(F.lit("SUCCESS"))
    f = l.select(F.col("doc_id").alias("seq"), level.alias("level"), F.concat(F.lit("group"), (F.col("doc_id") % 5).cast("string")).alias("category"), F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("message"))
    return quality.roll_up(f)

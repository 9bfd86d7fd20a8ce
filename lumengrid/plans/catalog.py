"""The engine's queries and the DuckDB SQL that gives the same rows."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fields
from ..operators import batch, camera, geometry, grid, histogram, normalize, qc, render, sampling, transfer, wavelet
from ..sources import readers, store
from ..streaming import cases as events
from . import config, pipeline

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) + 0.0 for c in cols})


def s6(*cols: str) -> str:
    return ", ".join(f"round({c}, 6) + 0.0 as {c}" for c in cols)


emb, li = fields.embedding_volumes, fields.lineitem_volume
EMB, LI = (f"with {fields.SQL[k]}" for k in ("emb", "li"))
LI_SHAPE = (9, 11, 50)
TF_DEMO = transfer.TransferFunction("TF01", ((0.0, 0.0, 0.0, 0.2, 0.0), (0.4, 0.9, 0.1, 0.3, 0.1), (0.7, 0.2, 0.8, 0.4, 0.6), (1.0, 1.0, 1.0, 0.5, 0.9)))
TF_TIES = transfer.TransferFunction("TF02", ((0.0, 0.0, 0.1, 0.2, 0.0), (0.5, 0.2, 0.3, 0.4, 0.2), (0.5, 0.8, 0.7, 0.6, 0.7), (1.0, 1.0, 0.9, 0.8, 1.0)))
TFS = [TF_DEMO, TF_TIES]
MINMAX = "select volume_id, z, y, x, case when hi > lo then (v - lo) / (hi - lo) else {flat} end as v from (select *, min(v) over (partition by volume_id) as lo, max(v) over (partition by volume_id) as hi from {src})"


def _points_sql(tf) -> str:
    return ", ".join(f"('{tf.name}', {i}, {', '.join(f'({x})::double' for x in p)})" for i, p in enumerate(tf.points))


def _lookup_sql(tfs, channel: str) -> str:
    """Joins values with segments: the last point at or below a value starts its segment."""
    return f"coalesce(s.{channel} + case when s.nx > s.x then (n.v - s.x) * ((s.n{channel} - s.{channel}) / (s.nx - s.x)) else 0 end, f.{channel})"


def _bake_sql(src: str, tfs, value: str = "v") -> str:
    pts = ", ".join(_points_sql(t) for t in tfs)
    lead = ", ".join(f"lead({c}, 1, {c}) over w as n{c}" for c in "xrgba")
    chans = ", ".join(f"{_lookup_sql(tfs, c)} as {c}" for c in "rgba")
    return f"""tf as (select * from (values {pts}) t(tf_name, ord, x, r, g, b, a)), names as (select distinct tf_name from tf),
seg as (select *, {lead} from tf window w as (partition by tf_name order by x, ord)),
firsts as (select tf_name, arg_min(r, ord) as r, arg_min(g, ord) as g, arg_min(b, ord) as b, arg_min(a, ord) as a from tf group by tf_name),
hit as (select n.volume_id, n.z, n.y, n.x, t.tf_name, n.{value} as v, max(tf.ord) as ord from {src} n cross join names t left join tf on tf.tf_name = t.tf_name and tf.x <= n.{value} group by all),
rgba as (select n.volume_id, n.tf_name, n.z, n.y, n.x, {chans} from hit n left join seg s on s.tf_name = n.tf_name and s.ord = n.ord join firsts f on f.tf_name = n.tf_name)"""


@query("agg01_minmax_norm", f"{EMB}, m as ({MINMAX.format(src='emb', flat='v')}) select volume_id, z, y, x, {s6('v')} from m")
def agg01(spark, d):
    return r6(normalize.minmax(emb(spark, d)), "v")


@query("agg02_percentile_norm", f"{EMB}, p as (select volume_id, quantile_cont(v, 0.01) as lo, quantile_cont(v, 0.99) as hi from emb group by 1) select volume_id, z, y, x, round(case when hi > lo then least(greatest((v - lo) / (hi - lo), 0.0), 1.0) else 0.0 end, 6) + 0.0 as v from emb join p using (volume_id)")
def agg02(spark, d):
    return r6(normalize.percentile(emb(spark, d)), "v")


@query("agg03_canonical_norm", f"{LI}, m as ({MINMAX.format(src='li', flat='0.0')}) select volume_id, z, y, x, {s6('v')} from m")
def agg03(spark, d):
    return r6(normalize.minmax(li(spark, d), "zero"), "v")


GEO = geometry.Geometry((0.5, 2.0, 1.5), (10.0, -4.0, 3.0), ((0.0, -1.0, 0.0), (1.0, 0.0, 0.0), (0.0, 0.0, 1.0)))
WORLD_SQL = "(y * 2.0 * (-1.0) + 10.0)::double as wx, (x * 0.5 + (-4.0))::double as wy, (z * 1.5 + 3.0)::double as wz"
BOUNDS_SQL = f"""tops as (select volume_id, max(x)::double as mx, max(y)::double as my, max(z)::double as mz from li group by 1),
corner as (select volume_id, mx * (k & 1) as x, my * ((k >> 1) & 1) as y, mz * ((k >> 2) & 1) as z from tops, range(0, 8) t(k)),
world as (select volume_id, {WORLD_SQL} from corner),
box as (select volume_id, min(wx) as xmin, max(wx) as xmax, min(wy) as ymin, max(wy) as ymax, min(wz) as zmin, max(wz) as zmax from world group by 1)"""


@query("agg04_volume_bounds", f"{LI}, {BOUNDS_SQL} select * from box")
def agg04(spark, d):
    return geometry.bounds(li(spark, d), GEO)


@query("agg05_histogram", f"{EMB} select volume_id, least(floor((v - (-0.5)) * (16 / 1.0)), 15)::int as bin, count(*) as n from emb where v between (-0.5) and 0.5 group by all")
def agg05(spark, d):
    return histogram.histogram(emb(spark, d), -0.5, 0.5, 16)


EDGES = f"""{EMB}, h as (select least(floor((v - (-0.5)) * (2048 / 1.0)), 2047)::int as bin, count(*) as n from emb where v between (-0.5) and 0.5 group by 1),
c as (select bin, sum(n) over (order by bin) as cdf, sum(n) over () as total from h),
e as (select k::int as edge, -0.5 + min(bin) * (1.0 / 2048) as x from c, range(1, 8) t(k) where cdf > total * k / 8.0 group by k)"""


@query("agg06_hist_eq_edges", f"{EDGES} select 0::bigint as volume_id, edge, {s6('x')} from (select edge, x::double as x from e union all select 0, -0.5 union all select 8, 0.5)")
def agg06(spark, d):
    pooled = emb(spark, d).withColumn("volume_id", F.lit(0).cast("long"))
    return r6(histogram.equalised_edges(histogram.histogram(pooled, -0.5, 0.5), -0.5, 0.5, 8), "x")


BAND_EDGES = [0.0, 5.0, 10.0, 15.0, 40.0]


BAND_STATS = f"""{LI}, b as (select *, case when v >= 0 and v < 5 then 1 when v >= 5 and v < 10 then 2 when v >= 10 and v < 15 then 3 when v >= 15 and v <= 40 then 4 end as band from li),
g as (select volume_id, band, count(*) as n, min(x) x0, max(x) x1, min(y) y0, max(y) y1, min(z) z0, max(z) z1 from b group by all),
t as (select volume_id, k::int as band, count(*) as total from li, range(1, 5) r(k) group by all),
s as (select t.*, coalesce(n, 0) as n, coalesce(n, 0)::double / total as share, x0, x1, y0, y1, z0, z1 from t left join g using (volume_id, band)),
bs as (select volume_id, band, n, share, case when share < 1e-4 then 'SKIP (Sparse)' when share > 1.0 then 'SKIP (Dense)' else 'KEEP' end as status, (x0 + x1) / 2.0::double as cx, (y0 + y1) / 2.0::double as cy, (z0 + z1) / 2.0::double as cz, 0.5 * sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2 + (z1 - z0) ** 2) as radius from s)"""


@query("agg07_band_stats", f"{BAND_STATS} select volume_id, band, n, round(share, 6) + 0.0 as share, status, {', '.join(f"case when status = 'KEEP' then {c} end as {c}" for c in ('cx', 'cy', 'cz'))}, case when status = 'KEEP' then round(radius, 6) end as radius from bs")
def agg07(spark, d):
    return r6(histogram.band_statistics(li(spark, d), BAND_EDGES), "share", "radius")


def frames_px(spark: SparkSession, d: str) -> DataFrame:
    """The embeddings as images of 16 x 4 pixels: a TF for each label, a frame for each vector."""
    label = spark.read.parquet(f"{d}/embeddings.parquet").select(F.col("vec_id").alias("volume_id"), "label")
    px = emb(spark, d).join(label, "volume_id")
    return px.select(F.concat(F.lit("TF"), F.lpad(F.col("label").cast("string"), 2, "0")).alias("tf_name"), F.lit("train").alias("split"), F.col("volume_id").alias("frame"), (F.col("z") * 4 + F.col("y")).alias("row"), F.col("x").alias("col"), F.greatest("v", F.lit(0.0)).alias("gray"))


PX = f"{EMB}, px as (select 'TF' || lpad(label::varchar, 2, '0') as tf_name, 'train' as split, volume_id as frame, greatest(v, 0.0) as gray from emb join embeddings on vec_id = volume_id)"
FM = f"{PX}, fm as (select tf_name, split, frame, avg(gray) as mean, avg((gray > 0.05)::int::double) as nonzero, stddev_pop(gray) as std from px group by all)"
TM = f"{FM}, tm as (select tf_name, count(*) as images, avg(mean) as mean, avg(nonzero) as nonzero, avg(std) as std from fm group by 1)"


@query("agg08_frame_metrics", f"{FM} select tf_name, split, frame, {s6('mean', 'nonzero', 'std')} from fm")
def agg08(spark, d):
    return r6(qc.frame_metrics(frames_px(spark, d), 0.05), "mean", "nonzero", "std")


@query("agg09_tf_metrics", f"{TM} select tf_name, images, {s6('mean', 'nonzero', 'std')} from tm")
def agg09(spark, d):
    return r6(qc.tf_metrics(qc.frame_metrics(frames_px(spark, d), 0.05)), "mean", "nonzero", "std")


VERDICT = f"""{TM}, tfs as (select 'TF' || lpad(i::varchar, 2, '0') as tf_name from range(0, 12) t(i)),
vd as (select tf_name, coalesce(images, 0) as images, case when coalesce(images, 0) = 0 then 'no_images' else concat_ws(',', case when nonzero < 0.34 then 'too_sparse' end, case when mean < 0.045 then 'too_dark' end, case when std < 0.05 then 'low_contrast' end) end as reasons from tfs left join tm using (tf_name))"""


def verdicts(spark: SparkSession, d: str) -> DataFrame:
    tfs = spark.range(12).select(F.format_string("TF%02d", "id").alias("tf_name"))
    return qc.verdict(tfs, qc.tf_metrics(qc.frame_metrics(frames_px(spark, d), 0.05)), 0.045, 0.34, 0.05)


@query("agg10_qc_verdict", f"{VERDICT} select tf_name, case when reasons = '' then 'pass' else 'fail' end as status, reasons, images from vd")
def agg10(spark, d):
    return verdicts(spark, d).select("tf_name", "status", F.array_join("reasons", ",").alias("reasons"), "images")


@query("agg11_qc_totals", f"{VERDICT} select count(*) as total, count(*) filter (reasons = '') as passed, count(*) filter (reasons <> '') as failed, coalesce(string_agg(tf_name, ',' order by tf_name) filter (reasons = ''), '') as passed_names, coalesce(string_agg(tf_name, ',' order by tf_name) filter (reasons <> ''), '') as failed_names from vd")
def agg11(spark, d):
    return qc.totals(verdicts(spark, d)).withColumns({c: F.array_join(c, ",") for c in ("passed_names", "failed_names")})


SEG = f"{PX}, sf as (select tf_name, split, frame, avg((gray >= 0.1)::int::double) as ratio, coalesce(avg(gray) filter (gray >= 0.1), 0.0) as confidence from px group by all)"


@query("agg12_seg_frames", f"{SEG} select tf_name, split, frame, {s6('ratio', 'confidence')}, ratio >= 0.25 and confidence >= 0.15 as detected from sf")
def agg12(spark, d):
    return r6(qc.segmentation_frames(frames_px(spark, d).withColumnRenamed("gray", "p"), 0.1, 0.25, 0.15), "ratio", "confidence")


@query("agg13_seg_verdict", f"{SEG}, dt as (select *, ratio >= 0.25 and confidence >= 0.15 as detected from sf) select tf_name, count(*) as total, count(*) filter (detected) as detected_frames, round(avg(detected::int::double), 6) + 0.0 as ratio, round(avg(ratio), 6) + 0.0 as mean_foreground_ratio, round(avg(confidence), 6) + 0.0 as mean_confidence, count(*) filter (detected) >= 3 and avg(detected::int::double) >= 0.1 as passed from dt group by 1")
def agg13(spark, d):
    frames = qc.segmentation_frames(frames_px(spark, d).withColumnRenamed("gray", "p"), 0.1, 0.25, 0.15)
    return r6(qc.segmentation_verdict(frames, 3), "ratio", "mean_foreground_ratio", "mean_confidence")


@query("agg16_mad", f"{EMB}, m as (select volume_id, quantile_disc(v, 0.5) as mid from emb group by 1), o as (select volume_id, abs(v - mid) as off from emb join m using (volume_id)) select volume_id, round(1.5 * greatest(quantile_disc(off, 0.5) / 0.6745, 1e-12), 6) + 0.0 as threshold from o group by 1")
def agg16(spark, d):
    return r6(normalize.mad_threshold(emb(spark, d), lam=1.5), "threshold")


@query("agg18_inspect", f"{LI} select volume_id, (max(z) + 1)::int as nz, (max(y) + 1)::int as ny, (max(x) + 1)::int as nx, count(*) as n_voxels, min(v) as v_min, max(v) as v_max from li group by 1")
def agg18(spark, d):
    return normalize.inspect(li(spark, d))


@query("prj01_index_to_world", f"{LI} select volume_id, z, y, x, v, {WORLD_SQL} from li")
def prj01(spark, d):
    return geometry.index_to_world(li(spark, d), GEO)


@query("prj02_world_to_index", f"{LI} select volume_id, z, y, x, x::double as ix, y::double as iy, z::double as iz from li")
def prj02(spark, d):
    return r6(geometry.world_to_index(geometry.index_to_world(li(spark, d), GEO), GEO), "ix", "iy", "iz").select("volume_id", "z", "y", "x", "ix", "iy", "iz")


@query("prj05_bbox_transform", f"{LI}, {BOUNDS_SQL}, t as (select *, 2.6 / case when greatest(xmax - xmin, ymax - ymin, zmax - zmin) < 1e-6 then 1.0 else greatest(xmax - xmin, ymax - ymin, zmax - zmin) end as scale from box), w as (select volume_id, z, y, x, {WORLD_SQL} from li) select w.volume_id, z, y, x, round((wx - (xmin + xmax) * 0.5) * scale, 6) + 0.0 as wx, round((wy - (ymin + ymax) * 0.5) * scale, 6) + 0.0 as wy, round((wz - (zmin + zmax) * 0.5) * scale, 6) + 0.0 as wz, 'render_world' as world_space from w join t using (volume_id)")
def prj05(spark, d):
    v = li(spark, d)
    moved = geometry.apply_transform(geometry.index_to_world(v, GEO), geometry.render_transform(geometry.bounds(v, GEO), 2.6))
    return r6(moved, "wx", "wy", "wz").select("volume_id", "z", "y", "x", "wx", "wy", "wz", "world_space")


@query("prj10_vector_magnitude", "select vec_id, round(sqrt(list_sum(list_transform(embedding, lambda e: e::double * e::double))), 6) as magnitude from embeddings")
def prj10(spark, d):
    return r6(spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", C.magnitude(F.col("embedding")).alias("magnitude")), "magnitude")


def norm_emb(spark, d):
    return normalize.minmax(emb(spark, d), "zero")


NORM = f"{EMB}, norm as ({MINMAX.format(src='emb', flat='0.0')})"


@query("tf01_bake_rgba", f"{NORM}, {_bake_sql('norm', TFS)} select volume_id, tf_name, z, y, x, {s6(*'rgba')} from rgba")
def tf01(spark, d):
    return r6(transfer.bake(norm_emb(spark, d), TFS), *"rgba")


@query("tf01_bake_premultiplied", f"{NORM}, {_bake_sql('norm', TFS)} select volume_id, tf_name, z, y, x, round(r * a, 6) + 0.0 as r, round(g * a, 6) + 0.0 as g, round(b * a, 6) + 0.0 as b, {s6('a')} from rgba")
def tf01p(spark, d):
    return r6(transfer.bake(norm_emb(spark, d), TFS, premultiply=True), *"rgba")


def _left_sql(c: str) -> str:
    return f"round(p.{c} + least(greatest((v - p.x) / (q.x - p.x + 1e-9), 0.0), 1.0) * (q.{c} - p.{c}), 6) + 0.0 as {c}"


@query("tf02_bake_left_tie", f"""{NORM}, tf as (select * from (values {_points_sql(TF_TIES)}) t(tf_name, ord, x, r, g, b, a)),
i as (select n.*, least(greatest((select count(*) from tf where tf.x < n.v), 1), 3) as k from norm n)
select volume_id, 'TF02' as tf_name, z, y, i.x as x, {', '.join(_left_sql(c) for c in 'rgba')} from i join tf p on p.ord = k - 1 join tf q on q.ord = k""")
def tf02(spark, d):
    return r6(transfer.bake(norm_emb(spark, d), [TF_TIES], left=True), *"rgba")


@query("tf03_gaussian", f"{NORM}, w as (select *, exp(-0.5 * power((v - 0.5) / 0.2, 2)) as w from norm) select volume_id, z, y, x, round(0.9 * w, 6) + 0.0 as r, round(0.4 * w, 6) + 0.0 as g, round(0.1 * w, 6) + 0.0 as b, round(1 - exp(-3.0 * w), 6) + 0.0 as a from w")
def tf03(spark, d):
    return r6(norm_emb(spark, d).select("volume_id", "z", "y", "x", *C.gaussian_rgba(F.col("v"), 0.5, 0.2, (0.9, 0.4, 0.1), 3.0)), *"rgba")


def _seg_sql(table: str, c: str) -> str:
    inner = f"(select p.{c} + case when q.x is null then 0 else (u.x - p.x) * ((q.{c} - p.{c}) / (q.x - p.x)) end from {table} p left join {table} q on q.i = p.i + 1 where p.x <= u.x order by p.x desc limit 1)"
    return f"coalesce({inner}, (select {c} from {table} order by x limit 1))"


@query("tf06_fuse_lut_pwf", f"""with l0 as (select p_size / 50.0::double as x, max(p_retailprice) / 3000 as r, min(p_retailprice) / 3000 as g, least(count(*) / 100.0::double, 1.0) as b from part group by 1), lut as (select *, row_number() over (order by x) as i from l0),
p0 as (select s_nationkey / 24.0::double as x, max(s_acctbal) / 10000 as a from supplier group by 1), pwf as (select *, row_number() over (order by x) as i from p0), u as (select x from lut union select x from pwf)
select round(x, 6) + 0.0 as x, {', '.join(f'round({_seg_sql("pwf" if c == "a" else "lut", c)}, 6) + 0.0 as {c}' for c in 'rgba')} from u""")
def tf06(spark, d):
    """A colour table of 50 sizes at most and an opacity table of 25 nations, fused."""
    part, supplier = spark.read.parquet(f"{d}/part.parquet"), spark.read.parquet(f"{d}/supplier.parquet")
    colours = part.groupBy((F.col("p_size") / 50.0).alias("x")).agg((F.max("p_retailprice") / 3000).alias("r"), (F.min("p_retailprice") / 3000).alias("g"), F.least(F.count("*") / 100.0, F.lit(1.0)).alias("b"))
    opacity = supplier.groupBy((F.col("s_nationkey") / 24.0).alias("x")).agg((F.max("s_acctbal") / 10000).alias("a"))
    return r6(transfer.fuse(colours, opacity), "x", *"rgba")


def _bands(spark, d: str, mode: str) -> DataFrame:
    """Opacity over value for the eight equalised bands of all embeddings."""
    pooled = emb(spark, d).withColumn("volume_id", F.lit(0).cast("long"))
    edges = [r["x"] for r in histogram.equalised_edges(histogram.histogram(pooled, -0.5, 0.5), -0.5, 0.5, 8).orderBy("edge").collect()]  # nine numbers
    rows = [(b, i, float(x), float(a)) for b in range(1, 9) for i, (x, a) in enumerate(transfer.band_points(b, edges, -0.5, 0.5, mode))]
    return r6(spark.createDataFrame(rows, "band int, ord int, x double, a double"), "x", "a")


def _bands_sql(body: str, off: str) -> str:
    return f"""{EDGES}, ed as (select edge, x::double as x from e union all select 0, -0.5 union all select 8, 0.5), b as (select (f.edge + 1)::int as band, f.x as low, t.x as high, t.x - f.x as w from ed f join ed t on t.edge = f.edge + 1),
p as (select band, 0 as o, -0.5::double as x, 0.0::double as a from b union all select band, 1, low - {off}, 0.0 from b where low > -0.5 union all {body}
union all select band, 200, high + {off}, 0.0 from b where high < 0.5 union all select band, 201, 0.5, 0.0 from b)
select band, (row_number() over (partition by band order by o) - 1)::int as ord, {s6('x', 'a')} from p"""


@query("tf07_bands_unit", _bands_sql("select band, 2, low + w * 0.001, 0.2 from b union all select band, 3, high - w * 0.001, 0.2 from b", "0.0"))
def tf07u(spark, d):
    return _bands(spark, d, "unit")


@query("tf07_bands_linear", _bands_sql("select band, 2, low + w * 0.05, 0.08 from b union all select band, 3, (low + high) / 2, 0.2 from b union all select band, 4, high - w * 0.05, 0.08 from b", "0.0"))
def tf07l(spark, d):
    return _bands(spark, d, "linear")


@query("tf07_bands_gaussian", _bands_sql("select band, 10 + i, low + w * i / 63, exp(-0.5 * power((low + w * i / 63 - (low + high) / 2) / (w / 4), 2)) from b, range(0, 64) t(i)", "0.0001"))
def tf07g(spark, d):
    return _bands(spark, d, "gaussian")


@query("tf10_tf_set", "with m as (select list(r_name order by r_regionkey) as names from region), n as (select count(*) as n from nation) select (i + 1)::int as idx, names[i % len(names) + 1] as cmap, 'TF' || lpad((i + 1)::varchar, 2, '0') as tf_name from m, n, range(0, 25) t(i) where i < n and i + 1 not in (4)")
def tf10(spark, d):
    """A transfer function for each nation, colour maps named after the regions in turn."""
    names = [r[0] for r in spark.read.parquet(f"{d}/region.parquet").orderBy("r_regionkey").select("r_name").collect()]  # names of maps are few
    bands = spark.read.parquet(f"{d}/nation.parquet").count()
    return spark.createDataFrame(transfer.tf_set(", ".join([*names, names[0]]) + "\n" + names[1], bands, frozenset({4})), "idx int, cmap string, tf_name string")


@query("grd01_target_shape", "select l_linenumber, greatest(1, round_even(9 * (l_linenumber / 4.0::double) / 1.5, 0)::int) as tz, greatest(1, round_even(11 * 0.5 / 1.0, 0)::int) as ty, greatest(1, round_even(50 * 0.01 / 2.0, 0)::int) as tx from (select distinct l_linenumber from lineitem)")
def grd01(spark, d):
    v = spark.read.parquet(f"{d}/lineitem.parquet").select("l_linenumber").distinct().select("l_linenumber", F.lit(9).alias("nz"), F.lit(11).alias("ny"), F.lit(50).alias("nx"), (F.col("l_linenumber") / 4.0).alias("sz"), F.lit(0.5).alias("sy"), F.lit(0.01).alias("sx"))
    return grid.target_shapes(v, (1.5, 1.0, 2.0)).select("l_linenumber", "tz", "ty", "tx")


def _tri_sql(src: str, shape, to) -> str:
    """One join of eight taps, by weights per axis."""
    maps = []
    for c, n, m in zip("zyx", shape, to, strict=True):
        pos = f"(o * ({n - 1} / {m - 1}.0::double))"
        maps.append(f"m{c} as (select o::int as o, k::int as k, case when k = least(floor({pos}), {n - 1}) then 1 - ({pos} - least(floor({pos}), {n - 1})) else {pos} - least(floor({pos}), {n - 1}) end as w from range(0, {m}) a(o), range(0, {n}) b(k) where k in (least(floor({pos}), {n - 1}), least(floor({pos}), {n - 1}) + 1))")
    return f"{', '.join(maps)}, tri as (select volume_id, mz.o as z, my.o as y, mx.o as x, sum(v * mz.w * my.w * mx.w) as v from {src} s join mz on mz.k = s.z join my on my.k = s.y join mx on mx.k = s.x group by all)"


@query("grd02_trilinear", f"{EMB}, {_tri_sql('emb', (4, 4, 4), (7, 3, 8))} select volume_id, z, y, x, {s6('v')} from tri")
def grd02(spark, d):
    return r6(grid.trilinear(emb(spark, d), (4, 4, 4), (7, 3, 8)), "v")


@query("grd03_nearest", f"{EMB} select volume_id, a.o::int as z, b.o::int as y, c.o::int as x, round(v, 6) + 0.0 as v from emb join range(0, 7) a(o) on a.o * 4 // 7 = z join range(0, 3) b(o) on b.o * 4 // 3 = y join range(0, 8) c(o) on c.o * 4 // 8 = x")
def grd03(spark, d):
    return r6(grid.nearest(emb(spark, d), (4, 4, 4), (7, 3, 8)), "v")


def _pad_sql(src: str, shape, n: int, fill: str) -> str:
    off = [(n - s) // 2 for s in shape]
    cells = f"(select i as volume_id, a::int as z, b::int as y, c::int as x from (select distinct volume_id as i from {src}), range(0, {n}) za(a), range(0, {n}) yb(b), range(0, {n}) xc(c))"
    return f"select g.volume_id, g.z, g.y, g.x, coalesce(s.v, {fill}) as v from {cells} g left join {src} s on s.volume_id = g.volume_id and s.z + {off[0]} = g.z and s.y + {off[1]} = g.y and s.x + {off[2]} = g.x"


@query("grd06_pad_cube_zero", f"{LI} {_pad_sql('li', LI_SHAPE, 52, '0.0')}")
def grd06z(spark, d):
    return grid.pad_to_cube(li(spark, d), LI_SHAPE, 52)


@query("grd06_pad_cube_min", f"{LI} {_pad_sql('li', LI_SHAPE, 50, '(select min(v) from li)')}")
def grd06m(spark, d):
    return grid.pad_to_cube(li(spark, d), LI_SHAPE, 0, "min")


@query("grd08_canonicalize", f"""{EMB}, {_tri_sql('emb', (4, 4, 4), (8, 4, 2))}, norm as ({MINMAX.format(src='tri', flat='0.0')}), pad as ({_pad_sql('norm', (8, 4, 2), 8, '0.0')}) select volume_id, z, y, x, {s6('v')} from pad""")
def grd08(spark, d):
    return r6(grid.canonicalize(emb(spark, d), (4, 4, 4), (0.5, 1.0, 2.0), 1.0).voxels, "v")


@query("grd09_tile_starts", "with c as (select distinct p_size + 3 as n, (1 + p_partkey % 9)::int as tile, (1 + p_partkey % 7)::int as stride from part) select distinct n, tile, stride, s::int as start from (select *, unnest(case when n <= tile then [0] else list_append(range(0, n - tile + 1, stride), n - tile) end) as s from c)")
def grd09(spark, d):
    c = spark.read.parquet(f"{d}/part.parquet").select((F.col("p_size") + 3).alias("n"), (1 + F.col("p_partkey") % 9).cast("int").alias("tile"), (1 + F.col("p_partkey") % 7).cast("int").alias("stride")).distinct()
    return c.select("n", "tile", "stride", F.explode(grid.tile_starts_of(F.col("n"), F.col("tile"), F.col("stride"))).alias("start"))


@query("grd10_tiles", f"""{EMB}, st(s) as (values (0), (1)) select volume_id, 'tile_z' || lpad(a.s::varchar, 4, '0') || '_y' || lpad(b.s::varchar, 4, '0') || '_x' || lpad(c.s::varchar, 4, '0') as tile_name, z - a.s as z, y - b.s as y, x - c.s as x, round(v, 6) + 0.0 as v
from emb join st a on z between a.s and a.s + 2 join st b on y between b.s and b.s + 2 join st c on x between c.s and c.s + 2""")
def grd10(spark, d):
    return r6(grid.split_tiles(emb(spark, d), (4, 4, 4), (3, 3, 3), (2, 2, 2)), "v")


@query("grd11_tile_trigger", "with c as (select p_partkey as id, p_size * 10 as nz, (p_partkey % 7 + 1) * 100 as ny, p_size * 17 as nx from part) select id, greatest(nz, ny, nx) > 512 as by_tile, nz::bigint * ny * nx > 10000000 or greatest(nz, ny, nx) > 600 as by_limit, nx > 400 or ny > 500 or nz > 300 as by_shape from c")
def grd11(spark, d):
    k, n = F.col("p_partkey"), F.col("p_size")
    c = spark.read.parquet(f"{d}/part.parquet").select(k.alias("id"), (n * 10).alias("nz"), ((k % 7 + 1) * 100).alias("ny"), (n * 17).alias("nx"))
    tile = (512, 512, 512)
    return c.select("id", grid.needs_tiles_of(tile).alias("by_tile"), grid.needs_tiles_of(tile, 10_000_000, 600).alias("by_limit"), grid.needs_tiles_of(tile, max_shape_xyz=(400, 500, 300)).alias("by_shape"))


@query("grd14_nearest_lookup", f"{LI}, p as (select i as point_id, 0::bigint as volume_id, i * 0.13::double - 1 as pz, i * 0.17::double as py, i * 0.77::double as px from range(0, 80) t(i)) select point_id, p.volume_id, {s6('pz', 'py', 'px')}, v from p left join li on z = least(greatest(round_even(pz, 0), 0), 8)::int and y = least(greatest(round_even(py, 0), 0), 10)::int and x = least(greatest(round_even(px, 0), 0), 49)::int")
def grd14(spark, d):
    i = F.col("id")
    pts = spark.range(80).select(i.alias("point_id"), F.lit(0).cast("long").alias("volume_id"), (i * 0.13 - 1).alias("pz"), (i * 0.17).alias("py"), (i * 0.77).alias("px"))
    return r6(grid.lookup(pts, li(spark, d), LI_SHAPE), "pz", "py", "px")


@query("grd13_rgba_lookup", f"{NORM}, {_bake_sql('norm', [TF_DEMO])}, p as (select distinct volume_id, 1.4::double as pz, 2.6::double as py, 9.0::double as px from norm) select p.volume_id, {s6(*'rgba')} from p join rgba q on q.volume_id = p.volume_id and q.z = 1 and q.y = 3 and q.x = 3")
def grd13(spark, d):
    v = norm_emb(spark, d)
    pts = v.select("volume_id").distinct().withColumns({"pz": F.lit(1.4), "py": F.lit(2.6), "px": F.lit(9.0)})
    return r6(grid.lookup(pts, transfer.bake(v, [TF_DEMO]), (4, 4, 4), values=tuple("rgba")), *"rgba").select("volume_id", *"rgba")


@query("prj09_linear_index", f"{LI} select volume_id, (z * 11 + y) * 50 + x as i, z, y, x from li")
def prj09(spark, d):
    return li(spark, d).select("volume_id", geometry.linear_index(11, 50).alias("i")).select("volume_id", "i", *geometry.from_linear(F.col("i"), 11, 50))


@query("prj11_gray", "select vec_id, k::int as k, round((embedding[3 * k + 1]::double + embedding[3 * k + 2]::double + embedding[3 * k + 3]::double) / 3.0, 6) + 0.0 as gray from embeddings, range(0, 21) t(k)")
def prj11(spark, d):
    e = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding", F.explode(F.sequence(F.lit(0), F.lit(20))).alias("k"))
    return r6(e.select("vec_id", "k", qc.gray(*[F.get("embedding", F.col("k") * 3 + i).cast("double") for i in range(3)]).alias("gray")), "gray")


@query("src15_cell_to_point", f"{LI}, c as (select volume_id, z + a as z, y + b as y, x + c as x, v from li, range(0, 2) ta(a), range(0, 2) tb(b), range(0, 2) tc(c)) select volume_id, z::int as z, y::int as y, x::int as x, round(avg(v), 6) + 0.0 as v from c group by all")
def src15(spark, d):
    return r6(readers.cell_to_point(li(spark, d)), "v")


@query("stream_event_windows", "select time_bucket(interval 60 minutes, ts) as start, event_type, count(*) as n, round(sum(value), 4) as total from events group by all")
def stream_windows(spark, d):
    """The windowed aggregate of the event stream, over the whole table as one batch."""
    e = events.event_windows(spark.read.parquet(f"{d}/events.parquet"))
    return e.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("stream_closed_windows", """with w as (select time_bucket(interval 60 minutes, ts) as start, event_type, count(*) as n, round(sum(value), 4) as total from events group by all), m as (select max(ts) as last from events)
select w.* from w, m where start + interval 60 minutes <= date_trunc('millisecond', last) - interval 2 hours""")
def stream_closed(spark, d):
    """The event stream to its end: the windows that its watermark has closed."""
    target = f"{store.shared_folder(spark)}/streams/windows-{uuid.uuid4().hex}"
    e = events.closed_windows(spark, f"{d}/events.parque[t]", target)  # a pattern, as the table may be one file
    return e.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


def U(seed: int, key: str) -> str:
    return f"((('0x' || substr(md5('{seed}:' || {key}), 1, 13))::bigint + 0.5) / {float(1 << 52)}::double)"


CELL_KEY = "volume_id || ':' || z || ':' || y || ':' || x"
DRAWN = f"""{NORM}, {_bake_sql('norm', TFS)}, k as (select *, -ln({U(7, CELL_KEY)}) / a as key from rgba where a > 0),
s as (select *, (row_number() over (partition by volume_id, tf_name order by key, z, y, x) - 1)::int as point_id from k)"""


@query("smp01_opacity_sample", f"{DRAWN} select volume_id, tf_name, point_id, z, y, x, {s6(*'rgba')} from s where point_id < 10")
def smp01(spark, d):
    return r6(sampling.opacity(transfer.bake(norm_emb(spark, d), TFS), 10, 7), *"rgba").select("volume_id", "tf_name", "point_id", "z", "y", "x", *"rgba")


@query("smp01_opacity_replace", f"""{LI}, w as (select *, sum(v) over (order by z, y, x) as upto, sum(v) over () as total from li), p as (select i::int as point_id, {U(3, "'0:' || i")} as u from range(0, 6000) t(i))
select 0::bigint as volume_id, 'TF01' as tf_name, point_id, z, y, x, v as a from p join w on u * total >= upto - v and u * total < upto""")
def smp01r(spark, d):
    v = li(spark, d).withColumn("tf_name", F.lit("TF01")).withColumnRenamed("v", "a")
    return sampling.opacity_with_replacement(v, 6000, 3).select("volume_id", "tf_name", "point_id", "z", "y", "x", "a")


@query("smp03_uniform", f"""{LI}, p as (select 0::bigint as volume_id, i::int as point_id, {U(15, "'0:' || i")} * 8 as pz, {U(16, "'0:' || i")} * 10 as py, {U(17, "'0:' || i")} * 49 as px from range(0, 500) t(i))
select p.volume_id, point_id, {s6('px', 'py', 'pz')}, v from p left join li on z = round_even(pz, 0)::int and y = round_even(py, 0)::int and x = round_even(px, 0)::int""")
def smp03(spark, d):
    return r6(sampling.uniform(li(spark, d), LI_SHAPE, 500, 5), "px", "py", "pz")


@query("smp05_even_subsample", f"{PX}, f as (select distinct tf_name, frame from px), n as (select *, row_number() over (partition by tf_name order by frame) - 1 as i, count(*) over (partition by tf_name) as n from f) select tf_name, frame from n where n <= 12 or i in (select round_even(k * (n - 1) / 11.0::double, 0)::int from range(0, 12) t(k))")
def smp05(spark, d):
    return sampling.even_subsample(frames_px(spark, d).select("tf_name", "frame").distinct(), ["tf_name"], ["frame"], 12)


def _haar_sql(src: str, dst: str, keys: str = "volume_id") -> str:
    sign = lambda b: " * ".join(["1"] + [f"(1 - 2 * ({c} % 2))" for k, c in zip(b, "zyx", strict=True) if k == "d"])
    bands = ", ".join(f"sum(v * {sign(b)}) * {wavelet.SCALE!r}::double as {b}" for b in wavelet.BANDS)
    return f"{dst} as (select {keys}, (z // 2)::int as z, (y // 2)::int as y, (x // 2)::int as x, {bands} from {src} group by all)"


def _detail_sql(src: str, j: int, keys: str = "volume_id") -> str:
    return " union all ".join(f"select {keys}, {j} as j, '{b}' as band, z, y, x, {b} as c from {src}" for b in wavelet.BANDS[1:])


HAAR1 = f"{EMB}, {_haar_sql('emb', 'h1')}, co as (select volume_id, 0 as j, 'aaa' as band, z, y, x, aaa as c from h1 union all {_detail_sql('h1', 1)})"
HAAR2 = f"{EMB}, {_haar_sql('emb', 'h1')}, a1 as (select volume_id, z, y, x, aaa as v from h1), {_haar_sql('a1', 'h2')}, co as (select volume_id, 0 as j, 'aaa' as band, z, y, x, aaa as c from h2 union all {_detail_sql('h1', 1)} union all {_detail_sql('h2', 2)})"


@query("wav01_haar_l1", f"{HAAR1} select volume_id, j, band, z, y, x, {s6('c')} from co")
def wav01(spark, d):
    return r6(wavelet.transform(emb(spark, d), (4, 4, 4), 1), "c")


@query("wav01_haar_l2", f"{HAAR2} select volume_id, j, band, z, y, x, {s6('c')} from co")
def wav01b(spark, d):
    return r6(wavelet.transform(emb(spark, d), (4, 4, 4), 2), "c")


#: Decomposition filters (low) of two wavelets, for the SQL; the operators work theirs out.
DB2 = (-0.12940952255126037, 0.2241438680420134, 0.8365163037378079, 0.48296291314453416)
DB4 = (-0.010597401785069032, 0.0328830116668852, 0.030841381835560764, -0.18703481171909309, -0.027983769416859854, 0.6308807679298589, 0.7148465705529157, 0.2303778133088965)
PLACES = {"periodic": "((m % 4) + 4) % 4", "zero": "case when m between 0 and 3 then m end", "symmetric": "case when ((m % 8) + 8) % 8 < 4 then ((m % 8) + 8) % 8 else 7 - ((m % 8) + 8) % 8 end", "reflect": "case when ((m % 6) + 6) % 6 < 4 then ((m % 6) + 6) % 6 else 6 - ((m % 6) + 6) % 6 end"}


def _bank_sql(low: tuple, mode: str) -> str:
    n = len(low)
    high = [x * (1 if k % 2 else -1) for k, x in enumerate(reversed(low))]
    rows = ", ".join(f"({k}, {a!r}::double, {d!r}::double)" for k, (a, d) in enumerate(zip(low, high, strict=True)))
    return f"""{EMB}, f as (select * from (values {rows}) t(k, low, high)), t0 as (select i, 2 * i + 1 - k as m, low, high from range(0, {(4 + n - 1) // 2}) r(i), f), t1 as (select i::int as i, {PLACES[mode]} as src, low, high from t0),
t as (select i, src, 'a' as b, low as w from t1 union all select i, src, 'd', high from t1)
select volume_id, case when tz.b || ty.b || tx.b = 'aaa' then 0 else 1 end as j, tz.b || ty.b || tx.b as band, tz.i as z, ty.i as y, tx.i as x, round(sum(v * tz.w * ty.w * tx.w), 6) + 0.0 as c
from emb join t tz on tz.src = z join t ty on ty.src = emb.y join t tx on tx.src = emb.x group by all"""


@query("wav01_db2_periodic", _bank_sql(DB2, "periodic"))
def wav_db2(spark, d):
    return r6(wavelet.transform(emb(spark, d), (4, 4, 4), 1, "db2"), "c")


@query("wav01_sym4_zero", _bank_sql(wavelet.SYM4, "zero"))
def wav_sym4(spark, d):
    return r6(wavelet.transform(emb(spark, d), (4, 4, 4), 1, "sym4", "zero"), "c")


@query("wav01_db4_symmetric", _bank_sql(DB4, "symmetric"))
def wav_db4(spark, d):
    return r6(wavelet.transform(emb(spark, d), (4, 4, 4), 1, "db4", "symmetric"), "c")


@query("wav01_db2_reflect", _bank_sql(DB2, "reflect"))
def wav_db2r(spark, d):
    return r6(wavelet.transform(emb(spark, d), (4, 4, 4), 1, "db2", "reflect"), "c")


@query("wav01_inverse", f"{EMB} select volume_id, z, y, x, {s6('v')} from emb")
def wav_inverse(spark, d):
    """Two levels of db2 and back."""
    return r6(wavelet.inverse(wavelet.transform(emb(spark, d), (4, 4, 4), 2, "db2"), (4, 4, 4), 2, "db2"), "v")


BUDGET = f"""{HAAR2}, e as (select volume_id, j, band, sum(c * c) as energy, count(*) as size from co group by all), sc as (select *, ln(1 + energy) * size * power(j + 1.0, -1.2) as score from e),
bu as (select volume_id, j, band, energy, size, greatest(floor(score / (sum(score) over (partition by volume_id) + 1e-12) * 40), 2)::int as k from sc)"""


@query("wav03_budget", f"{BUDGET} select volume_id, j, band, {s6('energy')}, size, k from bu")
def wav03(spark, d):
    return r6(wavelet.budgets(wavelet.transform(emb(spark, d), (4, 4, 4), 2), 40, least=2), "energy")


TOPK = f"{BUDGET}, rk as (select co.*, k, row_number() over (partition by volume_id, j, band order by abs(c) desc, z, y, x) as r from co join bu using (volume_id, j, band)), tk as (select * from rk where r <= k)"


@query("wav04_band_topk", f"{TOPK} select volume_id, j, band, z, y, x, {s6('c')} from tk")
def wav04(spark, d):
    c = wavelet.transform(emb(spark, d), (4, 4, 4), 2)
    return r6(wavelet.band_top(c, wavelet.budgets(c, 40, least=2)), "c").select("volume_id", "j", "band", "z", "y", "x", "c")


@query("wav_sampler", f"""{TOPK}, fin as (select *, (row_number() over (partition by volume_id order by abs(c) desc, j, band, z, y, x) - 1)::int as point_id, power(2.0, case when j = 0 then 2 else j end) as st from tk)
select volume_id, point_id, {', '.join(f'round(1.5 + ({c} - floor(4 / st) * 0.5) * st, 6) + 0.0 as p{c}' for c in 'xyz')}, round(abs(c), 6) + 0.0 as coeff_abs, j as level, band from fin where point_id < 40""")
def wavs(spark, d):
    return r6(wavelet.sample(emb(spark, d), (4, 4, 4), 40, 2, least=2), "px", "py", "pz", "coeff_abs")


CHANNELS = "volume_id, tf_name, ch"


@query("wav_sampler_rgba", f"""{NORM}, {_bake_sql('norm', TFS)}, lc as (select volume_id, tf_name, z, y, x, unnest(['r', 'g', 'b', 'a']) as ch, unnest([r, g, b, a]) as v from rgba),
{_haar_sql('lc', 'h1', CHANNELS)}, a1 as (select {CHANNELS}, z, y, x, aaa as v from h1), {_haar_sql('a1', 'h2', CHANNELS)},
cc as (select {CHANNELS}, 0 as j, 'aaa' as band, z, y, x, aaa as c from h2 union all {_detail_sql('h1', 1, CHANNELS)} union all {_detail_sql('h2', 2, CHANNELS)}),
co as (select volume_id, tf_name, j, band, z, y, x, sqrt(sum(c * c)) as c from cc group by all), e as (select volume_id, tf_name, j, band, sum(c * c) as energy, count(*) as size from cc group by all),
sc as (select *, ln(1 + energy) * size * power(j + 1.0, -1.2) as score from e), bu as (select *, greatest(floor(score / (sum(score) over (partition by volume_id, tf_name) + 1e-12) * 40), 2)::int as k from sc),
rk as (select co.*, k, row_number() over (partition by volume_id, tf_name, j, band order by c desc, z, y, x) as r from co join bu using (volume_id, tf_name, j, band)),
fin as (select *, (row_number() over (partition by volume_id, tf_name order by c desc, j, band, z, y, x) - 1)::int as point_id, power(2.0, case when j = 0 then 2 else j end) as st from rk where r <= k),
p as (select volume_id, tf_name, point_id, {', '.join(f'1.5 + ({c} - floor(4 / st) * 0.5) * st as p{c}' for c in 'xyz')}, c as coeff_abs, j as level, band from fin where point_id < 40)
select p.volume_id, p.tf_name, point_id, {s6('px', 'py', 'pz', 'coeff_abs')}, level, band, {s6(*'rgba')} from p join rgba q on q.volume_id = p.volume_id and q.tf_name = p.tf_name and {' and '.join(f'q.{c} = least(greatest(round_even(p{c}, 0), 0), 3)::int' for c in 'zyx')}""")
def wavs_rgba(spark, d):
    return r6(wavelet.sample_rgba(transfer.bake(norm_emb(spark, d), TFS), (4, 4, 4), 40, 2, least=2), "px", "py", "pz", "coeff_abs", *"rgba")


VF, HF = math.radians(45), 2 * math.atan(math.tan(math.radians(22.5)))
GOLDEN_TURN = 2 * math.pi * (1 - 2 / (1 + math.sqrt(5)))
POSES = f"""{LI}, {BOUNDS_SQL}, q as (select volume_id, (xmin + xmax) / 2 as cx, (ymin + ymax) / 2 as cy, (zmin + zmax) / 2 as cz, 0.8 * 0.5 * sqrt((xmax - xmin) ** 2 + (ymax - ymin) ** 2 + (zmax - zmin) ** 2) / sin({min(VF, HF)!r}::double / 2) as d from box),
p as (select q.*, i::int as pose_id, 2.0 * ((i + 0.5) / 64.0::double) - 1.0 as z, i * {GOLDEN_TURN!r}::double as t from q, range(0, 64) r(i)),
e as (select *, cx + d * sqrt(greatest(0.0, 1 - z * z)) * cos(t) as ex, cy + d * sqrt(greatest(0.0, 1 - z * z)) * sin(t) as ey, cz + d * z as ez from p),
f as (select *, (cx - ex) / d as fx, (cy - ey) / d as fy, (cz - ez) / d as fz from e),
h as (select *, case when abs(fy) > 0.98 then 0.0 else 1.0 end as hy, case when abs(fy) > 0.98 then 1.0 else 0.0 end as hz from f),
u as (select *, -(hy * fy + hz * fz) * fx as qx, hy - (hy * fy + hz * fz) * fy as qy, hz - (hy * fy + hz * fz) * fz as qz from h),
v as (select *, qx / sqrt(qx * qx + qy * qy + qz * qz) as ux, qy / sqrt(qx * qx + qy * qy + qz * qz) as uy, qz / sqrt(qx * qx + qy * qy + qz * qz) as uz from u),
w as (select *, fy * uz - fz * uy as rx, fz * ux - fx * uz as ry, fx * uy - fy * ux as rz from v)"""
MATRIX = [f"m{i}{k}" for i in range(3) for k in range(4)]
MATRIX_SQL = ", ".join(f"round({e}, 6) + 0.0 as m{i}{k}" for i, c in enumerate("xyz") for k, e in enumerate((f"r{c}", f"u{c}", f"-f{c}", f"e{c}")))


def poses(spark, d):
    """Cameras around each volume's box."""
    return camera.orbit(camera.fit(geometry.bounds(li(spark, d), GEO), VF, HF, 0.8), 64)


@query("cam01_fibonacci", f"{POSES} select volume_id, pose_id, {s6('ex', 'ey', 'ez', 'ux', 'uy', 'uz')} from v")
def cam01(spark, d):
    cols = ("ex", "ey", "ez", "ux", "uy", "uz")
    return r6(poses(spark, d), *cols).select("volume_id", "pose_id", *cols)


@query("cam02_focused", f"""{BAND_STATS}, tg as (select volume_id, band, cx, cy, cz, greatest(radius, 0.05 * side) / sin({VF!r}::double / 2) as d from bs join (select volume_id, greatest(max(x), max(y), max(z)) as side from li group by 1) using (volume_id) where status = 'KEEP'),
p as (select tg.*, i::int as pose_id, 2.0 * ((i + 0.5) / 16.0::double) - 1.0 as z, i * {GOLDEN_TURN!r}::double as t from tg, range(0, 16) r(i))
select volume_id, band, pose_id, round(cx + d * sqrt(greatest(0.0, 1 - z * z)) * cos(t), 6) + 0.0 as ex, round(cy + d * sqrt(greatest(0.0, 1 - z * z)) * sin(t), 6) + 0.0 as ey, round(cz + d * z, 6) + 0.0 as ez from p""")
def cam02(spark, d):
    """Cameras around the bands of each volume."""
    v = li(spark, d)
    side = normalize.inspect(v).select("volume_id", (F.greatest("nz", "ny", "nx") - 1).alias("side"))
    parts = histogram.band_statistics(v, BAND_EDGES).where("status = 'KEEP'").join(side, "volume_id").select("volume_id", "band", "cx", "cy", "cz", "radius", "side")
    return r6(camera.orbit(camera.focus(parts, VF), 16), "ex", "ey", "ez").select("volume_id", "band", "pose_id", "ex", "ey", "ez")


@query("cam03_c2w", f"{POSES} select volume_id, pose_id, {MATRIX_SQL} from w")
def cam03(spark, d):
    return r6(camera.camera_to_world(poses(spark, d)), *MATRIX).select("volume_id", "pose_id", *MATRIX)


@query("prj14_intrinsics", f"with c as (select distinct (p_size * 64)::int as w, (48 * (p_partkey % 10 + 1))::int as h from part) select w, h, round(h / 2.0::double / tan(radians(45) / 2) * w / h, 6) as fx, round(h / 2.0::double / tan(radians(45) / 2), 6) as fy, (w - 1) / 2.0::double as cx, (h - 1) / 2.0::double as cy, round(2 * atan(w::double / h * tan(radians(45) / 2)), 6) as hfov from c")
def prj14(spark, d):
    sizes = spark.read.parquet(f"{d}/part.parquet").select((F.col("p_size") * 64).cast("int").alias("w"), (48 * (F.col("p_partkey") % 10 + 1)).cast("int").alias("h")).distinct()
    return r6(sizes.select("w", "h", *C.intrinsic_columns(45, F.col("w"), F.col("h"))).drop("vfov"), "fx", "fy", "hfov")


def nation_frames(spark, d):
    """A frame for each nation, and how many there are."""
    frames = spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").cast("int").alias("pose_id"))
    return frames, frames.count()


@query("spl02_tail", "select n_nationkey::int as pose_id, case when n_nationkey >= n - 6 then 'test' when n_nationkey >= n - 9 then 'val' else 'train' end as split from nation, (select count(*) as n from nation)")
def spl02(spark, d):
    return camera.split_frames(*nation_frames(spark, d), 6, 3)


@query("spl03_interleave", """with c as (select count(*) as n from nation), te as (select distinct round_even(k * ((n - 1) / 6.0::double), 0)::int as i from c, range(0, 6) t(k)), re as (select n_nationkey as i, row_number() over (order by n_nationkey) - 1 as p from nation where n_nationkey not in (select i from te)),
va as (select i from re where p in (select round_even(k * (((select count(*) from re) - 1) / 3.0::double), 0)::int from range(0, 3) t(k)))
select n_nationkey::int as pose_id, case when n_nationkey in (select i from te) then 'test' when n_nationkey in (select i from va) then 'val' else 'train' end as split from nation""")
def spl03(spark, d):
    return camera.split_frames(*nation_frames(spark, d), 6, 3, "interleave")


@query("rnd04_frame_manifest", "with f as (select n_nationkey::int as pose_id, case when n_nationkey >= n - 6 then 'test' else 'train' end as split from nation, (select count(*) as n from nation)) select 'TF' || lpad((r_regionkey + 1)::varchar, 2, '0') as tf_name, pose_id, split, './' || split || '/r_' || lpad(pose_id::varchar, 4, '0') as file_path from region, f")
def rnd04(spark, d):
    tfs = spark.read.parquet(f"{d}/region.parquet").select(F.format_string("TF%02d", F.col("r_regionkey") + 1).alias("tf_name"))
    return camera.frame_manifest(tfs, camera.split_frames(*nation_frames(spark, d), 6, 0)).select("tf_name", "pose_id", "split", "file_path")


@query("rnd01_composite", f"""{NORM}, {_bake_sql('norm', TFS)}, b as (select *, coalesce(exp(sum(ln(greatest(1 - a, 1e-300))) over (partition by volume_id, tf_name, y, x order by z rows between unbounded preceding and 1 preceding)), 1.0) as before from rgba)
select volume_id, tf_name, y as row, x as col, {', '.join(f'round(sum(a * before * {c}), 6) + 0.0 as {c}' for c in 'rgb')}, round(sum(a * before), 6) + 0.0 as a from b group by all""")
def rnd01(spark, d):
    return r6(render.composite(transfer.bake(norm_emb(spark, d), TFS)), *"rgba")


@query("snk06_transforms_json", f"{POSES}, s as (select *, case when pose_id >= 54 then 'test' when pose_id >= 49 then 'val' else 'train' end as split from w) select volume_id, split, pose_id, './' || split || '/r_' || lpad(pose_id::varchar, 4, '0') as file_path, {MATRIX_SQL} from s")
def snk06(spark, d):
    """The frames' JSON, and what a reader gets from it."""
    cams = camera.split_frames(camera.camera_to_world(poses(spark, d)), 64, 10, 5)
    m = F.array(*[F.array(*[F.col(f"m{i}{k}") for k in range(4)]) for i in range(3)], F.array(*[F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)]))
    one = F.struct(F.col("pose_id"), F.format_string("./%s/r_%04d", "split", "pose_id").alias("file_path"), m.alias("transform_matrix"))
    docs = cams.groupBy("volume_id", "split").agg(F.to_json(F.array_sort(F.collect_list(one))).alias("frames"))  # a few hundred cameras of a volume
    back = docs.select("volume_id", "split", F.explode(F.from_json("frames", "array<struct<pose_id:int,file_path:string,transform_matrix:array<array<double>>>>")).alias("f"))
    return r6(back.select("volume_id", "split", "f.pose_id", "f.file_path", *[F.col("f.transform_matrix")[i][k].alias(f"m{i}{k}") for i in range(3) for k in range(4)]), *MATRIX)


def _starts_sql(axis: str, n: int, tile: int) -> str:
    return f"s{axis} as (select distinct least(i * {tile}, {n - tile})::int as s from range(0, {-(-n // tile)}) t(i))"


TILE_KEY = "'0#tile_z' || lpad(sz.s::varchar, 4, '0') || '_y' || lpad(sy.s::varchar, 4, '0') || '_x' || lpad(sx.s::varchar, 4, '0')"


@query("pipe01_tiles_in_one_plan", f"""{LI}, {', '.join(_starts_sql(c, n, 4) for c, n in zip('zyx', LI_SHAPE))}, tl as (select {TILE_KEY} as volume_id, sz.s as z0, sy.s as y0, sx.s as x0 from sz, sy, sx),
tv as (select tl.volume_id, z - z0 as z, y - y0 as y, x - x0 as x, v, min(v) over (partition by tl.volume_id) as lo, max(v) over (partition by tl.volume_id) as hi from tl join li on z between z0 and z0 + 3 and y between y0 and y0 + 3 and x between x0 and x0 + 3),
p as (select tl.*, i::int as point_id, {', '.join(f"{U(15 + k, 'volume_id || chr(58) || i')} * 3 as p{c}" for k, c in enumerate('zyx'))} from tl, range(0, 20) t(i) where volume_id in (select volume_id from tv))
select p.volume_id, point_id, round(py * 2.0 * (-1.0) + 10.0 - 2.0 * y0, 6) + 0.0 as x, round(px * 0.5 - 4.0 + 0.5 * x0, 6) + 0.0 as y, round(pz * 1.5 + 3.0 + 1.5 * z0, 6) + 0.0 as z, round(case when hi > lo then (v - lo) / (hi - lo) else v end, 6) + 0.0 as v
from p left join tv on tv.volume_id = p.volume_id and tv.z = round_even(pz, 0)::int and tv.y = round_even(py, 0)::int and tv.x = round_even(px, 0)::int""")
def pipe01(spark, d):
    """All tiles of the line items' volume through a document in one plan."""
    cfg = config.parse({"io": {"reader": "raw", "path": "0", "tile_size": 4}, "preprocess": [{"name": "normalize"}], "sampling": {"name": "uniform", "params": {"n_points": 20, "seed": 5}}})
    v = li(spark, d).withColumn("volume_id", F.lit("0"))
    state, targets, _ = pipeline.tiled(pipeline.State(v, LI_SHAPE, GEO), {"0": cfg})
    return r6(pipeline.run_volumes(spark, state, targets)[1].select("volume_id", "point_id", "x", "y", "z", "v"), "x", "y", "z", "v")


@query("pipe03_tf_fanout", f"{EMB} select volume_id, 'TF' || lpad(k::varchar, 2, '0') as tf_name, 'out/' || volume_id || '/TF' || lpad(k::varchar, 2, '0') || '/points.ply' as path from (select distinct volume_id from emb), range(1, 4) t(k)")
def pipe03(spark, d):
    tfs = spark.createDataFrame([(f"TF{i:02d}",) for i in range(1, 4)], "tf_name string")
    tasks = emb(spark, d).select("volume_id").distinct().crossJoin(F.broadcast(tfs))  # three rows
    return tasks.withColumn("path", F.format_string("out/%d/%s/points.ply", "volume_id", "tf_name"))


@query("pipe05_qc_filter", f"{VERDICT}, t as (select i as task_id, case when i % 5 = 0 then null else 'TF' || lpad((i % 12)::varchar, 2, '0') end as tf_name from range(0, 60) r(i)) select task_id, tf_name from t where tf_name in (select tf_name from vd where reasons = '') or (tf_name is null and exists (select 1 from vd where reasons = ''))")
def pipe05(spark, d):
    i = F.col("id")
    tasks = spark.range(60).select(i.alias("task_id"), F.when(i % 5 != 0, F.format_string("TF%02d", i % 12)).alias("tf_name"))
    return qc.keep_passed(tasks, verdicts(spark, d))


@query("pipe09_batch_assign", "with o as (select o_orderkey as case_id, row_number() over (order by md5('7:' || o_orderkey), o_orderkey) - 1 as i from (select distinct o_orderkey from orders)) select case_id, (i // 100 + 1)::int as batch_index, 'batch_' || lpad((i // 100 + 1)::varchar, greatest(4, length((((select count(*) from o) + 99) // 100)::varchar))::int, '0') as batch_id, (i % 100 + 1)::int as batch_case_index, 100 as batch_size, true as batch_shuffle, 7::bigint as batch_seed from o")
def pipe09(spark, d):
    return batch.assign(spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("case_id")).distinct(), 100, True, 7)


FLAG_GEO = geometry.Geometry((0.25, 0.25, 0.25), (0.0, 0.0, 0.0))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Opacity sampling: normalise, bake, draw, and place the points in render space."""
    v = norm_emb(spark, d)
    drawn = sampling.opacity(transfer.bake(v, TFS), 10, 7)
    world = geometry.index_to_world(drawn, FLAG_GEO)
    moved = geometry.apply_transform(world, geometry.render_transform(geometry.bounds(v, FLAG_GEO), 2.6))
    return r6(moved, "wx", "wy", "wz", *"rgba").select("volume_id", "tf_name", "point_id", "wx", "wy", "wz", *"rgba", "world_space")


query("flagship_opacity_points", f"{DRAWN} select volume_id, tf_name, point_id, {', '.join(f'round(({c} * 0.25 - 0.375) * (2.6 / 0.75), 6) + 0.0 as w{c}' for c in 'xyz')}, {s6(*'rgba')}, 'render_world' as world_space from s where point_id < 10")(flagship)

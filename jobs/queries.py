"""The jobs as queries over the given tables, each run twice into one new folder, and the DuckDB SQL that gives the same rows."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumengrid.operators import transfer
from lumengrid.plans import catalog as C
from lumengrid.sources import store

from . import corpus_volumes, point_clouds


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{store.shared_folder(spark)}/jobs/{name}-{uuid.uuid4().hex}"


def drawn(df: DataFrame) -> DataFrame:
    """Rows without a point have -1 for its number."""
    return df.withColumn("point_id", F.coalesce("point_id", F.lit(-1)))


def job1(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, config = new_folder(spark, "job1"), json.loads(point_clouds.DEFAULT.read_text())
    for _ in range(2):
        point_clouds.run(spark, f"{sf_dir}/embeddings.parquet", target, config)
    return C.r6(drawn(point_clouds.output(spark, target)), "mean", "nonzero", "std", "wx", "wy", "wz", *"rgba")


def job2(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, config = new_folder(spark, "job2"), json.loads(corpus_volumes.DEFAULT.read_text())
    for _ in range(2):
        corpus_volumes.run(spark, f"{sf_dir}/documents.parquet", target, config)
    return C.r6(drawn(corpus_volumes.output(spark, target)), "v", "band_from", *"rgba")


def _job1_sql(cfg: dict) -> str:
    tfs = [transfer.TransferFunction(n, tuple(map(tuple, p))) for n, p in cfg["transfer_functions"].items()]
    plane = {"z": ("y", "x"), "y": ("z", "x"), "x": ("z", "y")}
    view = lambda ax: f"""select volume_id, tf_name, '{ax}' as frame, {plane[ax][0]} as row, {plane[ax][1]} as col, (sum(a * b * r) + sum(a * b * g) + sum(a * b * bl)) / 3.0 as gray
from (select volume_id, tf_name, z, y, x, r, g, b as bl, a, coalesce(exp(sum(ln(greatest(1 - a, 1e-300))) over (partition by volume_id, tf_name, {', '.join(plane[ax])} order by {ax} rows between unbounded preceding and 1 preceding)), 1.0) as b from rgba) group by all"""  # noqa: E731
    q, size = cfg["qc"], 0.25 * 3
    place = ", ".join(f"round(case when point_id is not null then ({c} * 0.25 - {size / 2}) * ({cfg['target_bbox_size']} / {size}) end, 6) + 0.0 as w{c}" for c in "xyz")
    return f"""{C.NORM}, {C._bake_sql('norm', tfs)}, px as ({' union all '.join(map(view, cfg['axes']))}),
fm as (select volume_id, tf_name, frame, avg(gray) as mean, avg((gray > {q['pixel_threshold']})::int::double) as nonzero, stddev_pop(gray) as std from px group by all),
tm as (select volume_id, tf_name, count(*) as images, avg(mean) as mean, avg(nonzero) as nonzero, avg(std) as std from fm group by all),
vd as (select *, concat_ws(',', case when nonzero < {q['min_nonzero_ratio']} then 'too_sparse' end, case when mean < {q['min_mean_intensity']} then 'too_dark' end, case when std < {q['min_intensity_std']} then 'low_contrast' end) as reasons from tm),
k as (select rgba.*, -ln({C.U(cfg['seed'], C.CELL_KEY)}) / a as key from rgba join vd using (volume_id, tf_name) where a > 0 and reasons = ''),
s as (select *, (row_number() over (partition by volume_id, tf_name order by key, z, y, x) - 1)::int as point_id from k),
o as (select vec_id, row_number() over (order by md5('{cfg['seed']}:' || vec_id), vec_id) - 1 as i, count(*) over () as n from embeddings),
bt as (select vec_id as volume_id, 'batch_' || lpad((i // {cfg['batch_size']} + 1)::varchar, greatest(4, length(((n + {cfg['batch_size'] - 1}) // {cfg['batch_size']})::varchar))::int, '0') as batch_id from o)
select volume_id, tf_name, batch_id, case when reasons = '' then 'pass' else 'fail' end as status, reasons, images, {C.s6('mean', 'nonzero', 'std')}, coalesce(point_id, -1) as point_id, {place}, {C.s6(*'rgba')}
from vd join bt using (volume_id) left join (select * from s where point_id < {cfg['n_points']}) using (volume_id, tf_name)"""


def _job2_sql(cfg: dict) -> str:
    tf = transfer.TransferFunction("density", tuple(map(tuple, cfg["transfer_function"])))
    n, bands, bins = corpus_volumes.SHAPE, cfg["bands"], corpus_volumes.BINS
    space = corpus_volumes.SPACE
    return f"""with t as (select coalesce(nullif(lang, ''), 'und') as volume_id, coalesce(text, '') as t from documents),
w as (select volume_id, length(t) as chars, regexp_extract_all(t, '[^{space[1:]}+') as ws from t),
f as (select volume_id, chars, len(ws) as n, len(list_distinct(ws)) as d, length(array_to_string(ws, '')) as letters from w),
norm0 as (select volume_id, (case when n > 0 then d * 10 // n else 0 end)::int as z, least(case when n > 0 then letters // n else 0 end, {n[1] - 1})::int as y, least(case when chars > 0 then length(bin(chars)) else 0 end, {n[2] - 1})::int as x, count(*) as n from f group by all),
norm as (select *, n::double / max(n) over (partition by volume_id) as v from norm0), {C._bake_sql('norm', [tf])},
k as (select *, -ln({C.U(cfg['seed'], C.CELL_KEY)}) / a as key from rgba where a > 0),
s as (select *, (row_number() over (partition by volume_id order by key, z, y, x) - 1)::int as point_id from k),
h as (select volume_id, least(floor(v * {bins}), {bins - 1})::int as bin, count(*) as m from norm group by all),
c as (select *, sum(m) over (partition by volume_id order by bin) as cdf, sum(m) over (partition by volume_id) as total from h),
e as (select volume_id, q.k::int as edge, min(bin) * (1.0::double / {bins}) as x0 from c, range(1, {bands}) q(k) where cdf > total * q.k / {bands}.0::double group by all),
i as (select volume_id, list(x0) as inner_x from e group by all),
b as (select norm.*, (len(list_filter(coalesce(inner_x, []), lambda q: q <= v)) + 1)::int as band from norm left join i using (volume_id))
select b.volume_id, b.z, b.y, b.x, n, round(b.v, 6) + 0.0 as v, band, round(case when band = 1 then 0.0 else x0 end, 6) + 0.0 as band_from, coalesce(point_id, -1) as point_id, {C.s6(*'rgba')}
from b left join e on e.volume_id = b.volume_id and e.edge = band - 1 left join (select * from s where point_id < {cfg['n_points']}) s on s.volume_id = b.volume_id and s.z = b.z and s.y = b.y and s.x = b.x"""


QUERIES = {"job1_point_clouds": job1, "job2_corpus_volumes": job2}
ORACLES = {"job1_point_clouds": _job1_sql(json.loads(point_clouds.DEFAULT.read_text())), "job2_corpus_volumes": _job2_sql(json.loads(corpus_volumes.DEFAULT.read_text()))}

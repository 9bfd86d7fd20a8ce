"""One volume, its tiles, or many cases through a pipeline document: read, tile, preprocess, render, check, sample, export.

Tiles of a volume, and cases of one size and document, are volumes of one plan: stages work by volume_id, places that differ are a table, and files
are written in one job. So the number of jobs follows the kinds of cases, not the cases or tiles."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import batch as batches
from ..operators import camera, geometry, grid, normalize, qc, render, sampling, selection, transfer, wavelet
from ..sources import listing, readers, sinks, store
from . import config as C

READERS, STAGES, SAMPLERS, RENDERERS, EXPORTERS, SEGMENTERS = ({} for _ in range(6))
KINDS = {"reader": READERS, "stage": STAGES, "sampler": SAMPLERS, "renderer": RENDERERS, "exporter": EXPORTERS, "segmenter": SEGMENTERS}


def register(kind: str, name: str):
    def add(f):
        if name in KINDS[kind]:
            raise ValueError(f"{kind} {name} is there already")
        KINDS[kind][name] = f
        return f

    return add


def find(kind: str, name: str):
    try:
        return KINDS[kind][name]
    except KeyError:
        raise KeyError(f"unknown {kind} {name!r}; there are: {', '.join(sorted(KINDS[kind]))}") from None


@dataclass
class State:
    """What volumes of one size are at a point of the plan: voxels (or rgba once a transfer function is applied), size, geometry; shifts: how far
    each volume_id is moved in the world from that geometry (dx, dy, dz), if they are not all in one place."""

    voxels: DataFrame
    shape: tuple[int, int, int]
    geometry: geometry.Geometry = field(default_factory=geometry.Geometry)
    tfs: list = field(default_factory=list)
    rgba: DataFrame | None = None
    notes: dict = field(default_factory=dict)
    dtype: str | None = None
    shifts: DataFrame | None = None

    def moved(self, df: DataFrame, cols: dict[str, str]) -> DataFrame:
        """Columns (by axis) moved by the volumes' shifts; a row for each volume is broadcast if they are counted to be few."""
        if self.shifts is None:
            return df
        both = df.join(selection.bounded(self.shifts.select("volume_id", *[F.col(f"d{a}").alias(f"_d{a}") for a in "xyz"])), "volume_id", "left")
        return both.withColumns({c: F.col(c) + F.coalesce(f"_d{a}", F.lit(0.0)) for c, a in cols.items()}).drop("_dx", "_dy", "_dz")

    def world(self, df: DataFrame, src: tuple[str, ...], dst: tuple[str, ...] = ("x", "y", "z")) -> DataFrame:
        return self.moved(geometry.index_to_world(df, self.geometry, src, dst), dict(zip(dst, "xyz", strict=True)))

    def bounds(self) -> DataFrame:
        return self.moved(geometry.bounds(self.voxels, self.geometry), {f"{a}{end}": a for a in "xyz" for end in ("min", "max")})


@register("reader", "raw")
def _raw(spark, path, params):
    shape = params.pop("shape", None) or params.pop("shape_zyx", None)
    g = geometry.Geometry(tuple(params.pop("spacing", (1.0, 1.0, 1.0))), tuple(params.pop("origin", (0.0, 0.0, 0.0))), readers.codecs.parse_direction(params.pop("direction", None)))
    if not shape or len(shape) != 3:
        raise C.ConfigError("the raw reader needs shape: three sizes")
    return State(readers.read_raw(spark, path, tuple(shape), **params), tuple(shape), g, dtype=str(params.get("dtype", "uint16")))


def _whole(kind):
    def read(spark, path, params):
        h = readers.read_headers(spark, path, kind, **params).first()
        return State(readers.read_volumes(spark, path, kind, **params), (h["nz"], h["ny"], h["nx"]), readers.geometry_of(h), dtype=h["original_dtype"])

    return read


register("reader", "nii")(_whole("nii"))
register("reader", "nii.gz")(_whole("nii"))
register("reader", "vti")(_whole("vti"))


@register("stage", "normalize")
def _normalize(s: State, params):
    s.voxels = normalize.normalize(s.voxels, **{"method": "minmax", **params})
    return s


@register("stage", "canonicalize")
def _canonicalize(s: State, params):
    params = dict(params)
    vti = params.pop("vti_path", None)
    done = grid.canonicalize(s.voxels, s.shape, s.geometry.spacing, params.pop("target_spacing", 1.0), **{"dtype": s.dtype, **params})
    s.voxels, s.shape, s.geometry, s.shifts = done.voxels, done.shape, geometry.Geometry(), None
    s.notes["canonical"] = done.lineage
    if isinstance(vti, str):
        sinks.write_vti(s.voxels, s.shape, vti, s.geometry)
        s.notes["canonical_vti_path"] = vti
    elif vti:  # a path for each volume
        rows, paths = sinks.numbered(s.voxels, list(vti.items()), ("volume_id",))
        sinks.write_vti(rows, s.shape, paths, s.geometry, file=F.col("_file"))
        s.notes["canonical_vti_paths"] = vti
    return s


@register("stage", "tf")
def _tf(s: State, params):
    s.tfs = transfer_functions(s.voxels.sparkSession, params)
    s.rgba = transfer.bake(s.voxels, s.tfs, premultiply=_premultiply(params, True))
    return s


def _premultiply(params: dict, default: bool) -> bool:
    return bool(params.get("premultiply_alpha", params.get("premultiply", default)))


def transfer_functions(spark: SparkSession, params: dict) -> list[transfer.TransferFunction]:
    """Inline points, a file, or the files of a folder; then tf_name or tf_index picks one, else all."""
    if "points" in params:
        tfs = [transfer.TransferFunction(params.get("tf_name", "TF01"), tuple(map(tuple, params["points"])))]
    else:
        paths = [params["tf_json"]] if params.get("tf_json") else listing.tf_files(params["tf_dir"]) if params.get("tf_dir") else []
        if not paths:
            raise C.ConfigError("no transfer function: give points, tf_json or tf_dir")
        tfs = []
        for p in paths:
            t = readers.read_tf_json(spark, p, "*.json")
            tfs += transfer.from_table(t)
    if params.get("tf_name") and "points" not in params:
        tfs = [t for t in tfs if t.name == params["tf_name"]]
        if not tfs:
            raise C.ConfigError(f"no transfer function {params['tf_name']}")
    if params.get("tf_index") is not None:
        i = int(params["tf_index"])
        if not 0 <= i < len(tfs):
            raise C.ConfigError(f"tf_index {i} of {len(tfs)}")
        tfs = [tfs[i]]
    return tfs


@register("sampler", "opacity")
def _opacity(s: State, params):
    tfs = s.tfs or transfer_functions(s.voxels.sparkSession, params)
    rgba = s.rgba if s.rgba is not None else transfer.bake(s.voxels, tfs, premultiply=_premultiply(params, False))
    n, seed = int(params.get("n_points", 50_000)), int(params.get("seed", 0))
    many = n > s.shape[0] * s.shape[1] * s.shape[2]
    drawn = sampling.opacity_with_replacement(rgba, n, seed) if many else sampling.opacity(rgba, n, seed)
    density = F.col("a")
    if s.rgba is None:  # the scalar at the drawn cells; after a tf stage the volume is RGBA and its alpha stands for it
        drawn, density = drawn.join(s.voxels.select("volume_id", "z", "y", "x", F.col("v").alias("density")), ["volume_id", "z", "y", "x"]), F.col("density")
    placed = s.world(drawn.withColumnsRenamed({c: f"i{c}" for c in "xyz"}), ("ix", "iy", "iz"))
    return placed.select("volume_id", "tf_name", "point_id", "x", "y", "z", F.col("a").alias("opacity"), F.array("r", "g", "b").alias("rgb"), F.array("r", "g", "b", "a").alias("rgba"), density.alias("density"))


@register("sampler", "uniform")
def _uniform(s: State, params):
    if s.rgba is not None:
        raise ValueError("the uniform sampler takes scalar volumes")
    drawn = sampling.uniform(s.voxels, s.shape, int(params.get("n_points", 1000)), int(params.get("seed", 0)))
    return s.world(drawn, ("px", "py", "pz")).select("volume_id", F.lit(None).cast("string").alias("tf_name"), "point_id", "x", "y", "z", "v")


@register("sampler", "wavelet")
def _wavelet(s: State, params):
    how = s.shape, int(params.get("n_points", 10_000)), int(params.get("level", 1)), int(params.get("k_min", 100)), bool(params.get("centered", False)), float(params.get("alpha", 1.0)), float(params.get("beta", 1.0)), params.get("wavelet", "haar"), params.get("mode", "periodic")
    if s.rgba is None:
        drawn, tf, colours = wavelet.sample(s.voxels, *how), F.lit(None).cast("string").alias("tf_name"), []
    else:
        drawn, tf = wavelet.sample_rgba(s.rgba, *how), F.col("tf_name")
        colours = [F.col(c[0]).alias(c) for c in ("red", "green", "blue", "alpha")]
    return s.world(drawn, ("px", "py", "pz")).select("volume_id", tf, "point_id", "x", "y", "z", "coeff_abs", "level", *colours)


@register("renderer", "composite")
def _composite(s: State, params):
    """Frames along the axes for each transfer function, and where the camera of the full set would stand."""
    tfs = s.tfs or transfer_functions(s.voxels.sparkSession, params)
    rgba = transfer.bake(s.voxels, tfs)
    out = None
    for axis in params.get("axes", ["z", "y", "x"]):
        one = render.composite(rgba, axis).select("volume_id", "tf_name", F.lit("train").alias("split"), F.lit(axis).alias("frame"), "row", "col", "r", "g", "b", "a")
        out = one if out is None else out.unionByName(one)
    s.notes["render_transform"] = geometry.render_transform(s.bounds(), float(params.get("target_bbox_size", 2.6)))
    return out, tfs


def sample_canonical(spark: SparkSession, path: str, params: dict) -> DataFrame:
    """Opacity points of a canonical volume's file, as the sampler gives them."""
    return find("sampler", "opacity")(find("reader", "vti")(spark, path, {}), params)


#: Frames of a transfer function that are checked, and the order of its splits.
SAMPLE, SPLITS = 12, ("train", "test", "val")


def check(spark: SparkSession, frames: DataFrame, names: list[str] | DataFrame, how: dict) -> DataFrame:
    """Verdicts on the frames (tf_name, split, frame, row, col, r, g, b, a) of the named transfer functions (a list, or a table of tf_name): `sample_limit` of
    each, evenly spaced (all if it is 0), by brightness and, if `segmentation` is enabled, by the registered segmenter's masks."""
    t = how.get("thresholds", {})
    order = F.coalesce(F.array_position(F.array(*map(F.lit, SPLITS)), F.col("split")), F.lit(0)).alias("_order")
    limit = int(how.get("sample_limit", SAMPLE))
    if limit > 0:
        ids = frames.select(*qc.FRAME, order).distinct()
        frames = frames.join(sampling.even_subsample(ids, ["tf_name"], ["_order", "frame"], limit), qc.FRAME, "left_semi")
    px = frames.withColumn("gray", qc.gray(F.col("r"), F.col("g"), F.col("b")))
    metrics = qc.tf_metrics(qc.frame_metrics(px, how.get("pixel_threshold", t.get("pixel", 0.02))))
    least = [how.get(k, t.get(n, d)) for k, n, d in (("min_mean_intensity", "mean", 0.01), ("min_nonzero_ratio", "nonzero", 0.01), ("min_intensity_std", "std", 0.005))]
    masks, seg = None, how.get("segmentation") or {}
    if seg.get("enabled"):
        model = find("segmenter", seg.get("backend", "monai_unet"))(seg)
        probs = render.segment(frames, model, int(seg.get("in_channels", 4)), seg.get("mean"), seg.get("std"), seg.get("input_size"))
        found = qc.segmentation_frames(probs, seg.get("mask_threshold", 0.5), seg.get("min_foreground_ratio", 0.001), seg.get("min_confidence", 0.5))
        masks = qc.segmentation_verdict(found, seg.get("min_detected_frames", 1), seg.get("min_detected_ratio", 0.1))
    tfs = spark.createDataFrame([(n,) for n in names], "tf_name string") if isinstance(names, list) else names
    return qc.verdict(tfs, metrics, *least, segmentation=masks)


@register("exporter", "ply")
def _ply(points, path, **many):
    return sinks.write_ply(points, path, **many)


@register("exporter", "npz")
def _npz(points, path, **many):
    return sinks.write_npz(points, path, **many)


@register("exporter", "parquet")
def _parquet(points, path):
    points.write.mode("overwrite").parquet(path)


#: Exporters that write many files in one job: given the paths, and `file`, the column with a point's number of them.
MANY = {"ply", "npz"}


def export(name: str, points: DataFrame, files: list[tuple[str, str | None, str]]) -> None:
    """Points (volume_id, tf_name, ...) to a file for each of (volume_id, tf_name, path)."""
    if name in MANY:
        rows, paths = sinks.numbered(points, files, ("volume_id", "tf_name"))
        find("exporter", name)(rows.drop("volume_id", "tf_name"), paths, file=F.col("_file"))
        return
    for volume, tf, path in files:
        find("exporter", name)(points.where(F.col("volume_id").eqNullSafe(volume) & F.col("tf_name").eqNullSafe(tf)).drop("tf_name", "volume_id"), path)


def export_path(base: str, exporter: str, tf: str | None = None, many: bool = False, tile: str | None = None) -> str:
    """A folder gets points.<ext>; with many TFs a folder for each; a tile's name goes into the file's or the folder's name."""
    p = Path(base)
    if exporter != "parquet" and not p.suffix:
        p = p / f"points.{exporter}"
    if many and tf:
        p = p.parent / tf / p.name
    if tile:
        p = p.with_name(f"{p.stem}__{tile}{p.suffix}")
    return str(p)


SEP = "\x1f"


def check_volumes(spark: SparkSession, frames: DataFrame, volumes: list[str], names: list[str], how: dict) -> DataFrame:
    """check() for each volume by itself: its verdicts with volume_id."""
    both = F.concat_ws(SEP, "volume_id", "tf_name")
    tfs = spark.createDataFrame([(f"{v}{SEP}{n}",) for v in volumes for n in names], "tf_name string")
    done = check(spark, frames.withColumn("tf_name", both).drop("volume_id"), tfs, how)
    return done.withColumns({"volume_id": F.substring_index("tf_name", SEP, 1), "tf_name": F.substring_index("tf_name", SEP, -1)})


@dataclass
class Target:
    """A volume of a plan: the document that says where its files go, and the tile's name."""

    cfg: C.Config
    tile: str | None = None


def run_volumes(spark: SparkSession, state: State, targets: dict[str, Target]) -> tuple[dict[str, dict], DataFrame]:
    """Volumes of one size through the stages, by volume_id. Their documents differ in paths only; the written files and what was checked, for each; and the
    points of all."""
    cfg = next(iter(targets.values())).cfg
    for k, part in enumerate(cfg.preprocess):
        params = dict(part.params)
        if params.get("vti_path"):
            params["vti_path"] = {v: export_path(t.cfg.preprocess[k].params["vti_path"], "vti", tile=t.tile) for v, t in targets.items()}
        state = find("stage", part.name)(state, params)
    written = state.notes.get("canonical_vti_paths", {})
    results: dict[str, dict] = {v: {"outputs": [], "qc": None, "canonical_vti_path": written.get(v)} for v in targets}
    verdicts = None
    if cfg.render:
        frames, tfs = find("renderer", cfg.render.name)(state, cfg.render.params)
        state.tfs = state.tfs or tfs
        if cfg.qc is not None and cfg.qc.get("enabled", True):
            verdicts = store.saved(check_volumes(spark, frames, list(targets), [t.name for t in tfs], cfg.qc))
            if cfg.qc.get("report"):
                rows: dict[str, list[dict]] = {v: [] for v in targets}
                for r in verdicts.collect():  # a row for each volume and transfer function
                    rows[r["volume_id"]].append({c: x for c, x in r.asDict().items() if c != "volume_id"})
                for v, t in targets.items():
                    results[v]["qc"] = sinks.write_qc_report(rows[v], export_path(t.cfg.qc["report"], "json", tile=t.tile))
    points = find("sampler", cfg.sampling.name)(state, cfg.sampling.params)
    if "render_transform" in state.notes and cfg.sampling.name != "wavelet":
        points = geometry.apply_transform(points, state.notes["render_transform"], ("x", "y", "z"))
    else:
        points = points.withColumn("world_space", F.lit("canonical_world"))
    if verdicts is not None and cfg.qc.get("skip_failed_tf", True):
        passed = verdicts.where("status = 'pass'").select("volume_id", "tf_name")
        without = points.where("tf_name is null").join(passed.select("volume_id").distinct(), "volume_id", "left_semi")
        points = points.join(passed, ["volume_id", "tf_name"], "left_semi").unionByName(without)
    if cfg.export and cfg.export_path:
        points = points.persist()  # read, baked and drawn once for all files
        tfs_of: dict[str, list[str | None]] = {}
        for v, tf in points.select("volume_id", "tf_name").distinct().orderBy("volume_id", "tf_name").collect():  # one for each file
            tfs_of.setdefault(v, []).append(tf)
        files = [(v, tf, export_path(targets[v].cfg.export_path, cfg.export.name, tf, len(own) > 1, targets[v].tile)) for v, own in tfs_of.items() for tf in own]
        if files:
            export(cfg.export.name, points, files)
        for v, _, path in files:
            results[v]["outputs"].append(path)
        points.unpersist()
    for v, r in results.items():
        r["points"] = points.where(F.col("volume_id") == v)
    return results, points


def tiled(state: State, cfgs: dict[str, C.Config]) -> tuple[State, dict[str, Target], dict[str, list[tuple]]]:
    """The volumes cut into tiles where the document wants it: the tiles as volumes, where their files go, and of each volume (tile's volume_id, name, origin)."""
    t = next(iter(cfgs.values())).tiling
    if not t or not grid.needs_tiles(state.shape, t["tile"], **t["limits"]):
        return state, {v: Target(c) for v, c in cfgs.items()}, {v: [(v, None, None)] for v in cfgs}
    split = grid.split_tiles(state.voxels, state.shape, t["tile"], t["stride"], t["pad"])
    split = store.saved(split.withColumn("volume_id", F.concat_ws("#", "volume_id", "tile_name")).drop("tile_name"))  # stages read them more than once
    g, targets, of, shifts = state.geometry, {}, {v: [] for v in cfgs}, []
    before = {r["volume_id"]: (r["dx"], r["dy"], r["dz"]) for r in state.shifts.collect()} if state.shifts is not None else {}  # a row for each volume
    tiles = grid.tiles(state.shape, t["tile"], t["stride"])
    for v, cfg in cfgs.items():
        for name, z, y, x, *_ in tiles:
            key = f"{v}#{name}"
            targets[key] = Target(cfg, name)
            of[v].append((key, name, (x, y, z)))
            shifts.append((key, *(before.get(v, (0.0, 0.0, 0.0))[i] + sum(g.direction[i][k] * g.spacing[k] * (x, y, z)[k] for k in range(3)) for i in range(3))))
    size = t["tile"] if t["pad"] else tiles[0][4:]  # all tiles are of one size
    table = state.voxels.sparkSession.createDataFrame([(k, *map(float, d)) for k, *d in shifts], "volume_id string, dx double, dy double, dz double")
    return State(split, tuple(size), g, dtype=state.dtype, shifts=table), targets, of


def run_state(spark: SparkSession, state: State, cfgs: dict[str, C.Config]) -> dict[str, list[dict]]:
    """Of each volume its results: one, or one for each tile."""
    state, targets, of = tiled(state, cfgs)
    done, _ = run_volumes(spark, state, targets)
    return {v: [done[key] if name is None else {"tile": name, "tile_origin_index_xyz": origin, **done[key]} for key, name, origin in parts] for v, parts in of.items()}


def run(spark: SparkSession, doc: dict) -> list[dict]:
    """A whole document: one result, or one for each tile."""
    cfg = C.parse(doc)
    state = find("reader", cfg.reader.name)(spark, cfg.path, dict(cfg.reader.params))
    state.voxels = state.voxels.withColumn("volume_id", F.lit(str(cfg.path)))
    return run_state(spark, state, {str(cfg.path): cfg})[str(cfg.path)]


#: Readers whose files can be read together, and their kinds.
TOGETHER = {"nii": "nii", "nii.gz": "nii", "vti": "vti"}


def _alike(doc: dict) -> str:
    """The document without the paths, by which cases can differ within a plan."""
    d = json.loads(json.dumps(doc, default=str))
    d.get("io", {}).pop("path", None)
    d.get("export", {}).pop("path", None)
    for how in (d.get("qc"), (d.get("render") or {}).get("qc")):
        if isinstance(how, dict):
            how.pop("report", None)
    for part in d.get("preprocess") or []:
        if isinstance(part, dict) and isinstance(part.get("params"), dict) and part["params"].get("vti_path"):
            part["params"]["vti_path"] = True
    return json.dumps(d, sort_keys=True)


def _groups(spark: SparkSession, docs: dict[str, dict], errors: dict[str, str]) -> list[tuple[str, list[str], dict]]:
    """Cases that share a plan: (reader's kind or "", cases, header by case). Headers that can't be read become errors."""
    alike: dict[str, list[str]] = {}
    for case, doc in docs.items():
        alike.setdefault(_alike(doc), []).append(case)
    out = []
    for own in alike.values():
        try:
            cfg = C.parse(docs[own[0]])
        except Exception as e:
            errors.update(dict.fromkeys(own, f"{type(e).__name__}: {e}"))
            continue
        if cfg.reader.name not in TOGETHER:
            out += [("", [case], {}) for case in own]
            continue
        of = {listing.plain(docs[case]["io"]["path"]): case for case in own}
        heads: dict[tuple, dict] = {}
        read = readers.read_headers(spark, [docs[case]["io"]["path"] for case in own], TOGETHER[cfg.reader.name], strict=False, **cfg.reader.params)
        for h in read.collect():  # a row for each case
            case = of[listing.plain(h["volume_id"])]
            if h["error"]:
                errors[case] = h["error"]
            else:
                same = (h["nz"], h["ny"], h["nx"], tuple(h["spacing"]), tuple(map(tuple, h["direction"])), h["original_dtype"])
                heads.setdefault(same, {})[case] = h
        out += [(TOGETHER[cfg.reader.name], sorted(group), group) for group in heads.values()]
    return out


def _run_group(spark: SparkSession, kind: str, cases: list[str], heads: dict, docs: dict[str, dict]) -> dict[str, list[dict]]:
    if not kind:
        return {case: run(spark, docs[case]) for case in cases}
    cfgs = {case: C.parse(docs[case]) for case in cases}
    first = heads[cases[0]]
    voxels = readers.read_volumes(spark, [docs[c]["io"]["path"] for c in cases], kind, **cfgs[cases[0]].reader.params)
    names = spark.createDataFrame([(heads[c]["volume_id"], c) for c in cases], "volume_id string, _case string")  # a row for each case
    voxels = voxels.join(selection.bounded(names), "volume_id").select(F.col("_case").alias("volume_id"), "z", "y", "x", "v")
    shifts = None
    if any(heads[c]["origin"] != first["origin"] for c in cases):
        shifts = spark.createDataFrame([(c, *(float(a - b) for a, b in zip(heads[c]["origin"], first["origin"], strict=True))) for c in cases], "volume_id string, dx double, dy double, dz double")
    state = State(voxels, (first["nz"], first["ny"], first["nx"]), readers.geometry_of(first), dtype=first["original_dtype"], shifts=shifts)
    return run_state(spark, state, cfgs)


def run_batch(spark: SparkSession, doc: dict, root: str, reader: str | None = None, size: int = 100, shuffle: bool = True, seed: int = 0, stop_on_error: bool = False, report: str | None = None, pattern: str = "s*", filename: str | None = None) -> dict:
    """All cases under root, each with the document's templates filled in; those of one size and document in one plan. Errors are kept per case: a file that
    can't be read is found by its header; should a plan fail, its cases are tried one by one."""
    reader = reader or doc.get("io", {}).get("reader")
    found = {c["case_id"]: c for c in listing.cases(spark, root, reader, pattern, filename)}
    rows, docs = [], {}
    for index, batch_id, place, case_id in batches.assign_list(sorted(found), size, shuffle, seed):
        one = C.fill(doc, {**found[case_id], "batch_index": index, "batch_id": batch_id, "batch_case_index": place})
        one.setdefault("io", {})["path"] = one["io"].get("path") or found[case_id]["input_path"]
        docs[case_id] = one
        rows.append({"case_id": case_id, "batch_id": batch_id, "status": "succeeded", "error": None, "outputs": []})
    errors: dict[str, str] = {}
    results: dict[str, list[dict]] = {}
    todo = _groups(spark, docs, errors)
    while todo:
        kind, cases, heads = todo.pop(0)
        if errors and stop_on_error:
            break
        try:
            results |= _run_group(spark, kind, cases, heads, docs)
        except Exception as e:
            if len(cases) > 1:
                todo = [(kind, [c], {c: heads[c]}) for c in cases] + todo
                continue
            if stop_on_error:
                raise
            errors[cases[0]] = f"{type(e).__name__}: {e}"
    if errors and stop_on_error:
        raise RuntimeError("; ".join(f"{c}: {e}" for c, e in sorted(errors.items())))
    for row in rows:
        row["outputs"] = [p for r in results.get(row["case_id"], []) for p in r["outputs"]]
        if row["case_id"] in errors:
            row |= {"status": "failed", "error": errors[row["case_id"]]}
    total = {"cases": rows, "succeeded": sum(r["status"] == "succeeded" for r in rows), "failed": sum(r["status"] == "failed" for r in rows), "total_batches": -(-len(rows) // size)}
    if report:
        Path(report).parent.mkdir(parents=True, exist_ok=True)
        Path(report).write_text(json.dumps(total, indent=2))
        lines = [f"succeeded: {total['succeeded']}, failed: {total['failed']}, batches: {total['total_batches']}", "", "| case | batch | status | error |", "|-|-|-|-|"]
        Path(report).with_suffix(".md").write_text("\n".join([*lines, *(f"| {r['case_id']} | {r['batch_id']} | {r['status']} | {r['error'] or '-'} |" for r in rows)]) + "\n")
    return total


def plan_cameras(spark: SparkSession, box: tuple[float, ...], n: int = 64, vfov: float = 45.0, w: int = 800, h: int = 800, scale: float = 0.8, test: int = 10, val: int = 0, strategy: str = "tail") -> DataFrame:
    """Poses with matrices and splits around a box (xmin, xmax, ymin, ymax, zmin, zmax)."""
    from ..functions.columns import intrinsics

    k = intrinsics(vfov, w, h)
    centre = tuple((box[2 * i] + box[2 * i + 1]) / 2 for i in range(3))
    d = camera.fit_distance(tuple(box[2 * i + 1] - box[2 * i] for i in range(3)), k["vfov"], k["hfov"], scale)
    return camera.split_frames(camera.camera_to_world(camera.fibonacci(spark, n, centre, d)), n, test, val, strategy)

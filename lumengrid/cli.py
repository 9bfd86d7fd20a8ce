"""Command line: run, batch, list, inspect, test-seg."""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lumengrid")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("run").add_argument("config")
    b = sub.add_parser("batch")
    b.add_argument("config")
    for name, kind in (("--root", str), ("--batch-size", int), ("--seed", int), ("--report", str), ("--pattern", str), ("--filename", str)):
        b.add_argument(name, type=kind)
    b.add_argument("--no-shuffle", action="store_true")
    sub.add_parser("list")
    i = sub.add_parser("inspect")
    i.add_argument("path")
    i.add_argument("--reader", default="vti")
    s = sub.add_parser("test-seg")
    s.add_argument("frames")
    s.add_argument("--model", required=True, help="module:function, from images to probabilities; with --checkpoint from the file's bytes to such a function")
    s.add_argument("--checkpoint", help="the model's file, which is sent to the workers")
    s.add_argument("--sha256", help="what its digest must be")
    s.add_argument("--channels", type=int, default=3)
    s.add_argument("--threshold", type=float, default=0.5)
    s.add_argument("--output")
    a = p.parse_args(argv)

    from .operators import normalize, qc, render
    from .plans import config, pipeline
    from .sources import readers

    if a.command == "list":
        print(json.dumps({k: sorted(v) for k, v in pipeline.KINDS.items()}, indent=2))
        return 0
    spark = SparkSession.builder.appName("lumengrid").getOrCreate()
    if a.command == "run":
        for r in pipeline.run(spark, config.load(a.config)):
            print("\n".join(r["outputs"]))
    elif a.command == "batch":
        doc = config.load(a.config)
        own = doc.pop("batch", {})  # arguments win over the document
        root = a.root or own.get("root")
        if not root:
            p.error("batch needs a root")
        total = pipeline.run_batch(spark, doc, root, size=a.batch_size or own.get("batch_size", 100), shuffle=not a.no_shuffle and own.get("shuffle", True), seed=a.seed if a.seed is not None else own.get("seed", 0), report=a.report or own.get("report"), pattern=a.pattern or own.get("case_glob", "s*"), filename=a.filename or own.get("filename"))
        print(json.dumps({k: v for k, v in total.items() if k != "cases"}))
        return 1 if total["failed"] else 0
    elif a.command == "inspect":
        header = readers.read_headers(spark, a.path, a.reader).first().asDict()
        print(json.dumps(header | normalize.inspect(readers.read_volumes(spark, a.path, a.reader)).first().asDict(), indent=2, default=str))
    else:
        module, name = a.model.split(":")
        model = getattr(importlib.import_module(module), name)
        if a.checkpoint:
            images = readers.read_images(spark, a.frames)
            found = render.segment_images(images, render.ModelFile(a.checkpoint, model, a.sha256), a.channels, threshold=a.threshold)
            frames = qc.detected(found.select(*readers.frame_of("path"), "ratio", "confidence"))
        else:
            frames = qc.segmentation_frames(render.segment(readers.read_pixels(spark, a.frames), model, a.channels), a.threshold)
        rows = [r.asDict() for r in qc.segmentation_verdict(frames).collect()]
        text = json.dumps(rows, indent=2)
        print(text)
        if a.output:
            with open(a.output, "w", encoding="utf-8") as f:
                f.write(text)
    return 0


if __name__ == "__main__":
    sys.exit(main())

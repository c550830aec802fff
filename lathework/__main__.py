"""Command line: ``python -m lathework COMMAND``; errors of input exit with 2, refusals and failures with 1."""

from __future__ import annotations

import argparse
import json
import shutil
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.functions import png, text
from lathework.operators import collection, contracts, registry, relational, rendering, reports, sampling, sequential
from lathework.plans import build, catalog, export, runner
from lathework.sources import readers
from lathework.sources.decoder import Programs
from lathework.sources.writers import write_table


def session() -> SparkSession:
    return SparkSession.builder.appName("lathework").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def run_query(args: argparse.Namespace) -> int:
    found = catalog.queries()
    if args.name not in found:
        raise ValueError(f"no query {args.name}; there are: {', '.join(sorted(found))}")
    write_table(found[args.name](session(), args.tables), args.out)
    return 0


def dedup(args: argparse.Namespace) -> int:
    items = session().read.parquet(args.items)
    clusters = relational.exact_clusters(items)
    write_table(clusters, f"{args.out}/clusters")
    write_table(relational.cluster_members(items, clusters), f"{args.out}/items")
    return 0


def split(args: argparse.Namespace) -> int:
    config = sequential.SplitConfig(**json.loads(Path(args.config).read_text()))
    write_table(sequential.greedy_split(session().read.parquet(args.clusters), config), args.out)
    return 0


def generate(args: argparse.Namespace) -> int:
    lines = [x.strip(text.BLANKS) for x in Path(args.corpus).read_text().splitlines()]
    write_table(sampling.draw_samples(session(), args.n, args.seed, [x for x in lines if x and x[0] != "#"]), args.out)
    return 0


def normalize(args: argparse.Namespace) -> int:
    own = text.normalize(F.col("value"), args.version)
    write_table(session().read.text(args.path).select("value", own.alias("normalized"), text.detect_script(F.col("value")).alias("script")), args.out)
    return 0


def status(args: argparse.Namespace) -> int:
    run = runner.load_run(Path(args.folder))
    if run is None:
        raise ValueError(f"no run in {args.folder}")
    for s in run.stages.values():
        print(s.name, s.status, s.error or "")
    return int(any(s.status == "failed" for s in run.stages.values()))


def checked(samples: DataFrame) -> int:
    """Prints what the samples break."""
    bad = contracts.sample_violations(samples).orderBy("id", "rule").collect()
    for r in bad:
        print(r.id, r.rule)
    print(f"{samples.count()} samples, {len(bad)} violations")
    return 2 if bad else 0


def document(path: str) -> dict:
    """A JSON file with an object on top."""
    found = json.loads(Path(path).read_text())
    if not isinstance(found, dict):
        raise ValueError(f"{path} is no JSON object")
    return found


def validate_sample(args: argparse.Namespace) -> int:
    return checked(session().createDataFrame([document(args.path)], contracts.schema()))


def validate_manifest(args: argparse.Namespace) -> int:
    doc = document(args.path)
    if doc.get("split") not in sequential.SPLITS:
        raise ValueError("a manifest needs a split")
    return checked(session().createDataFrame(doc.get("samples", []), contracts.schema()))


def render_one(args: argparse.Namespace) -> int:
    given = document(args.config)
    made = rendering.render(png.decode(Path(args.clean).read_bytes())[..., :3], given.pop("text"), tuple(given.pop("center")), **given)
    for name, image in (("rendered", made.image), ("alpha", made.alpha), ("mask", made.mask * 255)):
        build.saver(args.out)(f"{name}.png", png.encode(image))
    (Path(args.out) / "metadata.json").write_text(json.dumps({"image_size": list(made.image.shape[1::-1]), "effect_bbox_xyxy": made.effect_box, "pairing_ok": made.pairing.ok}))
    return 0


def probe(args: argparse.Namespace) -> int:
    print(json.dumps(Programs(args.video).probe(), indent=1))
    return 0


def ingest(args: argparse.Namespace) -> int:
    config = build.Ingest(**document(args.config)) if args.config else build.Ingest()
    rows = build.ingest(session(), args.videos.split(","), Programs, config, args.out).collect()
    manifests = [json.loads(r.manifest) for r in rows if r.manifest]
    Path(args.out).mkdir(parents=True, exist_ok=True)
    (Path(args.out) / "manifest.json").write_text(json.dumps(manifests, ensure_ascii=False, indent=1))
    for r in rows:
        if r.error:
            print(r.video, r.error, file=sys.stderr)
    return int(any(r.error for r in rows))


def report(args: argparse.Namespace) -> int:
    samples = session().read.parquet(args.samples)
    targets = session().createDataFrame([(int(a), int(z), float(w)) for a, z, w in document(args.targets)["buckets"]], "lo int, hi int, weight double")
    buckets = reports.durations(samples, "duration_ms", targets, args.tolerance)
    for r in buckets.orderBy("lo", "hi").collect():
        print(json.dumps(r.asDict()))
    print(reports.verdict(buckets, samples.count(), args.least))
    return 0


def source_rules(args: argparse.Namespace) -> int:
    bad = registry.registry_violations(session().read.parquet(args.registry), "source_id").collect()
    for r in bad:
        print(r.source_id, r.rule)
    return 2 if bad else 0


def source_check(args: argparse.Namespace) -> int:
    found = registry.authorised(session().read.parquet(args.registry).where(F.col("source_id") == args.source), F.lit(args.day).cast("date")).first()
    if found is None:
        raise ValueError(f"no source {args.source}")
    print("; ".join(found.reasons) or "authorised")
    return int(not found.authorized)


def collect(args: argparse.Namespace) -> int:
    readers.register(session())
    items = session().read.format("item_manifest").option("source_id", args.source).load(args.url)
    files = []
    for r in collection.pending(items, ledger_of(args.out), most=args.most).collect():  # bounded by --most
        to = Path(args.out) / r.source_id / r.item_id
        _, error = collection.attempt(lambda r=r, to=to: collection.resume(collection.over_http(r.url), to), collection.delays(1.0, 3))
        files.append((r.source_id, r.item_id, None if error else f"{r.source_id}/{r.item_id}", error))
    got = session().createDataFrame(files, LEDGER + ", error string")
    got.where("error is null").drop("error").write.mode("append").parquet(f"{args.out}/ledger")
    for f in files:
        print(f[1], f[3] or "fetched")
    return int(any(f[3] for f in files))


LEDGER = "source_id string, item_id string, path string"


def ledger_of(folder: str) -> DataFrame:
    at = Path(folder) / "ledger"
    return session().read.parquet(str(at)) if at.exists() else session().createDataFrame([], LEDGER)


def forget(args: argparse.Namespace) -> int:
    ledger = ledger_of(args.out)
    request = session().createDataFrame([(args.source, args.item)], "source_id string, item_id string")
    if ledger.join(request, collection.KEYS, "left_semi").isEmpty():
        raise ValueError(f"{args.item} of {args.source} was not fetched")
    write_table(collection.remove(ledger, request, Path(args.out)), f"{args.out}/ledger.new")
    shutil.rmtree(f"{args.out}/ledger")
    Path(f"{args.out}/ledger.new").rename(f"{args.out}/ledger")
    return 0


def export_tables(args: argparse.Namespace) -> int:
    doc = session().read.option("multiLine", True).json(args.manifest)
    for name, df in export.flat_manifest(doc).items():
        write_table(df, f"{args.out}/{name}")
    return 0


def workflow(args: argparse.Namespace) -> int:
    doc = document(args.config)
    videos, parts = doc.pop("videos"), {"ingest": build.Ingest(**doc.pop("ingest", {})), "plan": sampling.Plan(**doc.pop("plan", {}))}
    run = build.build(session(), videos, Programs, build.Build(**doc, **parts), Path(args.out), force=args.force == "yes")
    print(run.run_id)
    return 0


COMMANDS = {
    "query": (run_query, {"name": str, "tables": str, "out": str}),
    "dedup": (dedup, {"items": str, "out": str}),
    "split": (split, {"clusters": str, "config": str, "out": str}),
    "generate": (generate, {"corpus": str, "n": int, "seed": int, "out": str}),
    "normalize": (normalize, {"path": str, "version": str, "out": str}),
    "status": (status, {"folder": str}),
    "validate-sample": (validate_sample, {"path": str}),
    "validate-manifest": (validate_manifest, {"path": str}),
    "render": (render_one, {"clean": str, "config": str, "out": str}),
    "probe": (probe, {"video": str}),
    "ingest": (ingest, {"videos": str, "config": str, "out": str}),
    "report": (report, {"samples": str, "targets": str, "tolerance": float, "least": int}),
    "source-rules": (source_rules, {"registry": str}),
    "source-check": (source_check, {"registry": str, "source": str, "day": str}),
    "collect": (collect, {"source": str, "url": str, "most": int, "out": str}),
    "forget": (forget, {"source": str, "item": str, "out": str}),
    "export": (export_tables, {"manifest": str, "out": str}),
    "workflow": (workflow, {"config": str, "out": str, "force": str}),
}
#: What need not be given.
DEFAULTS = {"config": "", "tolerance": 0.1, "least": 1, "most": 100, "force": "no"}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser("lathework")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, (_, names) in COMMANDS.items():
        own = commands.add_parser(name)
        for option, kind in names.items():
            free = option in DEFAULTS and not (option == "config" and name in ("split", "render", "workflow"))
            own.add_argument(f"--{option}", type=kind, required=not free, default=DEFAULTS.get(option))
    args = parser.parse_args(argv)
    try:
        return COMMANDS[args.command][0](args)
    except PermissionError as e:
        print(e, file=sys.stderr)
        return 1
    except (ValueError, OSError) as e:
        print(e, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())

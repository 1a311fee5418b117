"""Command line: ``python -m sievemill --folder RUN ...`` runs the literature funnel, or one part of it."""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sievemill.operators import screen
from sievemill.plans import funnel, state
from sievemill.sources import services, workbooks
from sievemill.sources.shared_tables import exists, read_text, write_text

log = logging.getLogger("sievemill")

SCREENING = ["search", "seeds", "references", "details", "cited", "screened"]
#: Modes that exclude one another, with the stages that each may do; none is all of them.
MODES = {"stop_before_ai": SCREENING, "classify_only": ["classified"], "curation_only": ["curation"], "finalize_only": []}
SERVICES = ("search", "references", "details", "model")


class RunLog(logging.Handler):
    """Keeps what is logged as a text in the run's folder, in whatever file system it is."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self.path = spark, f"{folder.rstrip('/')}/pipeline.log"
        self.lines = read_text(spark, self.path).splitlines() if exists(spark, self.path) else []
        self.setFormatter(logging.Formatter("%(asctime)s [%(levelname)s] %(message)s"))

    def emit(self, record: logging.LogRecord) -> None:
        self.lines.append(self.format(record))

    def close(self) -> None:
        write_text(self.spark, self.path, "\n".join(self.lines) + "\n")
        super().close()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("sievemill", description=__doc__)
    p.add_argument("--folder", required=True, help="the run's folder, in any file system that Spark reaches")
    p.add_argument("--resume", action="store_true", help="go on with the run that the folder holds")
    p.add_argument("--config", help="a JSON file with any of these options; the command line goes before it")
    p.add_argument("--query", help="what to search for, without years")
    p.add_argument("--years", help="years, as a list with commas or from-to")
    p.add_argument("--dedupe-order", choices=["citations", "relevance"], help="which of several articles of one title stays")
    for name in ("most-per-year", "most-seeds", "page-size", "detail-batch", "most-answers"):
        p.add_argument(f"--{name}", type=int)
    p.add_argument("--detail-rate", type=float, help="calls per second of all tasks together")
    p.add_argument("--policy-version")
    p.add_argument("--no-scope", action="store_true", help="screen by the resource lexicon alone")
    p.add_argument("--curated", help="workbooks of the curated table, for --finalize-only")
    p.add_argument("--reviewed", help="workbooks of the reviewed rows, for --finalize-only")
    p.add_argument("--neural-columns", default="tissue_or_brain_region;cell_type", help="columns that tell of the nervous system")
    for name in SERVICES:
        p.add_argument(f"--{name}-address", help=f"address of the service: {name}")
    modes = p.add_mutually_exclusive_group()
    for name in MODES:
        modes.add_argument(f"--{name.replace('_', '-')}", action="store_true")
    return p


def options(argv: list[str], spark: SparkSession) -> argparse.Namespace:
    """The command line over the configuration file over the defaults."""
    args = parser().parse_args(argv)
    if args.config:
        said = json.loads(read_text(spark, args.config))
        known = {k for k in vars(args) if k not in ("folder", "config")}
        if unknown := sorted(set(said) - known):
            raise ValueError(f"unknown options in {args.config}: {', '.join(unknown)}")
        for k, v in said.items():
            if getattr(args, k) in (None, False, parser().get_default(k)):
                setattr(args, k, v)
    if len(chosen := [m for m in MODES if getattr(args, m)]) > 1:
        raise ValueError(f"modes exclude one another: {', '.join(chosen)}")
    return args


def config_of(args: argparse.Namespace, transports: dict[str, Callable]) -> funnel.Config:
    given = {k: getattr(args, k) for k in ("dedupe_order", "most_per_year", "most_seeds", "page_size", "detail_batch", "detail_rate", "policy_version", "most_answers") if getattr(args, k) is not None}
    mode = next((m for m in MODES if getattr(args, m)), None)
    return funnel.Config(args.query or "", args.years or "", args.folder, args.resume, scope=None if args.no_scope else screen.SCOPE_PATTERN, stages=MODES[mode] if mode else None, transports=transports, **given)


def finalized(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The final catalog and its audit, as workbooks in the run's folder."""
    if not args.curated or not args.reviewed:
        raise ValueError("--finalize-only needs --curated and --reviewed")
    read = lambda path: workbooks.read(spark, path).fillna("")
    final, audit = funnel.finalize(read(args.curated), read(args.reviewed), args.neural_columns.split(";"))
    for name, df in (("final", final), ("canonical", audit)):
        workbooks.write(df, f"{args.folder.rstrip('/')}/{name}")
        log.info("%s: %d rows", name, df.count())
    return final


def main(argv: list[str] | None = None, spark: SparkSession | None = None, transports: dict[str, Callable] | None = None) -> int:
    """0 if all is done, 3 if the run pauses and can be resumed."""
    spark = spark or SparkSession.builder.appName("sievemill").getOrCreate()
    args = options(sys.argv[1:] if argv is None else argv, spark)
    transports = transports or {n: services.JsonTransport(getattr(args, f"{n}_address")) for n in SERVICES if getattr(args, f"{n}_address")}
    begun = exists(spark, f"{args.folder.rstrip('/')}/state.json")
    if begun and not args.resume and not args.finalize_only:
        raise FileExistsError(f"run exists: {args.folder}")
    log.setLevel(logging.INFO)
    kept = RunLog(spark, args.folder)
    shown = logging.StreamHandler()
    handlers = (kept, shown)
    for h in handlers:
        log.addHandler(h)
    try:
        write_text(spark, f"{args.folder.rstrip('/')}/config.json", json.dumps(vars(args), indent=1, ensure_ascii=False))
        if args.finalize_only:
            finalized(spark, args)
            return 0
        config = config_of(args, transports)
        try:
            rows = funnel.run(spark, config)
            log.info("curation: %d rows", rows.count())
        except state.NotEnabled as stop:
            if not args.stop_before_ai:
                raise
            log.info("stopped before %s", stop.stage)
        except state.Paused as pause:
            log.info("paused: %s", pause)
            return 3
        finally:
            counts = state.RunState.open(args.folder, True).counts if exists(spark, f"{args.folder.rstrip('/')}/state.json") else {}
            for stage, n in counts.items():
                log.info("%s: %d", stage, n)
        return 0
    except Exception:
        log.exception("the run failed")
        raise
    finally:
        for h in handlers:
            log.removeHandler(h)
            h.close()


if __name__ == "__main__":
    sys.exit(main())

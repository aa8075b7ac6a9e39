"""``python -m ondol.cli``: a thin front over the library; tables are snapshot tables under ``--root`` (or ONDOL_ROOT)."""

from __future__ import annotations

import argparse
import json
import os
import sys
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import functions as F

from . import workflow
from .operators import audit, boards, load, pipeline, relational, tables, validate
from .schemas import ensure_tables
from .session import materialize, session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ondol")
    p.add_argument("--root", default=os.environ.get("ONDOL_ROOT"))
    p.add_argument("--master", default=os.environ.get("ONDOL_MASTER"))
    p.add_argument("--now", help="the time to work at, in ISO form (UTC); the current time without it")
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("sources").add_subparsers(dest="what", required=True)
    s.add_parser("list")
    s.add_parser("show").add_argument("name")
    s.add_parser("check")
    sub.add_parser("transform").add_argument("--limit", type=int, default=500)
    sub.add_parser("load").add_argument("--limit", type=int, default=load.BATCH)
    sub.add_parser("validate").add_argument("--run-id")
    sub.add_parser("run-all").add_argument("--limit", type=int, default=500)
    c = sub.add_parser("cleanup").add_subparsers(dest="what", required=True)
    c.add_parser("mark-stale").add_argument("--days", type=int, default=14)
    c.add_parser("purge-pages").add_argument("--days", type=int, default=90)
    w = sub.add_parser("workflow").add_subparsers(dest="what", required=True)
    for name in ("run", "status"):
        w.add_parser(name).add_argument("name", choices=sorted(workflow.WORKFLOWS))
    w.add_parser("history").add_argument("--last", type=int, default=20)
    w.add_parser("list")
    return p


class Commands:
    def __init__(self, args: argparse.Namespace, spark=None):
        self.args, self.spark = args, spark or session("ondol", args.master)
        self.at = datetime.fromisoformat(args.now) if args.now else datetime.now(UTC).replace(tzinfo=None)
        self.now = F.lit(self.at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
        self.t = ensure_tables(self.spark, args.root)

    def sources(self) -> int:
        rows = self.t["sources"].read()
        if self.args.what == "check":
            known = self.spark.createDataFrame([(b,) for b in boards.REGISTRY], "name string")
            found = relational.differences({"without a layout": (rows.select("name"), known)}).collect()
            for r in found:
                print(f"{r.label}: {r['name']}")
            return int(bool(found))
        if self.args.what == "show":
            rows = rows.where(F.col("name") == self.args.name)
        for r in rows.orderBy("id").toJSON().toLocalIterator():
            print(r)
        return 0

    def _audited(self, task: str, work) -> int:
        runs = self.t["etl_runs"].read()
        number = (runs.agg(F.max("id")).first()[0] or 0) + 1
        named = {"dag_id": "cli", "task_id": task, "run_id": f"cli_{self.at:%Y%m%d_%H%M%S}"}
        events = audit.start(self.spark, number, self.at, **named)
        try:
            counts, status, error = work(), "success", None
        except Exception as e:
            counts, status, error = {}, "failed", f"{type(e).__name__}: {e}"
        events = events.unionByName(audit.finish(self.spark, number, self.at, status, error, **counts))
        done = audit.runs(events)
        self.t["etl_runs"].write(runs.unionByName(done.select(*[F.col(c).cast(runs.schema[c].dataType) for c in runs.columns])))
        print(json.dumps({"task": task, "status": status, "error": error, **counts}))
        return int(status != "success")

    def transform(self) -> int:
        def work() -> dict[str, int]:
            stored, names = self.t["listings_staging"].read(), self.t["sources"].read().select(F.col("id").alias("source_id"), F.col("name").alias("board"))
            pages = relational.unmatched(self.t["scraped_pages"].read(), stored, ["source_id", "content_hash"])
            pages = relational.latest_per_key(pages.select("id", "source_id", "url", "html_content", "content_hash", "fetched_at"), ["source_id", "url"], "fetched_at", "id")
            pages = relational.top_per_key(pages, ["source_id"], self.args.limit, F.desc("fetched_at"), F.col("id")).join(names, "source_id", "left")
            known = F.col("board").isin(*boards.REGISTRY)
            good, bad = pipeline.transform(pages.withColumn("board", F.when(known, F.col("board")).otherwise("default")), self.now)
            # natural keys give the ids of rows that are new: after the largest, by rank of the key
            keys = ["source_id", "source_listing_id"]
            good = materialize(tables.last_writer(good, keys, "content_hash"), "transformed")
            largest = stored.agg(F.max("id")).first()[0] or 0
            new = relational.numbered(good, [], F.col("source_id"), F.col("source_listing_id")).withColumn("id", F.lit(largest) + F.col("number")).drop("number")
            recent = stored.where(F.col("loaded_at").isNull() & (F.col("parsed_at") >= self.now - F.expr("INTERVAL 7 DAYS"))).select("id", *keys, "title_ko", "rent_monthly_usd", "city", "posted_at_utc")
            marked = materialize(pipeline.duplicates(new, recent), "duplicates")
            new = new.drop("is_duplicate", "canonical_id").join(marked, "id", "left")
            merged = tables.upsert(stored, new.select(*stored.columns), keys, ["id", "url", "loaded_at"])
            self.t["listings_staging"].write(merged.select(*[F.col(c).cast(stored.schema[c].dataType) for c in stored.columns]))
            return {"rows_extracted": pages.count(), "rows_transformed": good.count(), "rows_failed": bad.count()}

        return self._audited("transform", work)

    def load(self) -> int:
        def work() -> dict[str, int]:
            staging, listings = self.t["listings_staging"].read(), self.t["listings"].read()
            rows = materialize(load.unloaded(staging, limit=self.args.limit), "batch")
            merged, refused, ids = load.load(listings, rows, self.t["sources"].read(), self.now)
            ids = materialize(ids, "ids")
            self.t["listings"].write(merged)
            self.t["listings_staging"].write(load.mark(staging, ids, self.now))
            return {"rows_loaded": ids.count(), "rows_failed": refused.count()}

        return self._audited("load", work)

    def validate(self) -> int:
        staging, runs, known = self.t["listings_staging"].read(), self.t["etl_runs"].read(), self.t["sources"].read().select(F.col("id").alias("source_id"))
        name = getattr(self.args, "run_id", None)
        chosen = audit.resolve(runs, name).first() if name else runs.where("task_id = 'transform'").agg(F.max("id").alias("id")).first()
        if chosen is None or chosen.id is None:
            print("no such run", file=sys.stderr)
            return 1
        run, others = runs.where(F.col("id") == chosen.id), runs.where(F.col("id") != chosen.id).orderBy(F.desc("id")).limit(5)
        both = run.select(F.col("rows_transformed").alias("r")).join(others.agg(F.nullif(F.avg("rows_transformed"), F.lit(0.0)).alias("a")))
        rows = staging.where(F.col("parsed_at").between(*[F.lit(x) for x in run.select("started_at", F.coalesce("finished_at", self.now)).first()]))
        checks = validate.report(validate.row_count(both, F.col("r"), F.col("a")), validate.success_rate(run, "rows_transformed", "rows_failed"), validate.null_rate(rows, ["address_raw", "title_ko"]), validate.orphans(staging, known, ["source_id"]))
        try:
            print(json.dumps(validate.run(checks, chosen.id), ensure_ascii=False))
        except validate.ValidationError as e:
            print(e, file=sys.stderr)
            return 1
        return 0

    def run_all(self) -> int:
        for step in (self.transform, self.load, self.validate):
            if code := step():
                return code
        return 0

    def cleanup(self) -> int:
        age = self.now - F.make_dt_interval(F.lit(self.args.days))
        if self.args.what == "mark-stale":
            rows, stale = self.t["listings"].read(), F.col("is_active") & (F.col("last_seen_at") < age)
            n = load.counts(rows, stale).first().n
            self.t["listings"].write(tables.update_where(rows, stale, {"is_active": F.lit(False), "updated_at": self.now}))
        else:
            rows, old = self.t["scraped_pages"].read(), F.col("fetched_at") < age
            n = load.counts(rows, old).first().n
            self.t["scraped_pages"].write(tables.delete_where(rows, old))
        print(json.dumps({self.args.what: n}))
        return 0


def main(argv: list[str] | None = None, spark=None) -> int:
    args = parser().parse_args(argv)
    if args.command == "workflow":
        root = Path(args.root or ".")
        history = workflow.History(root / "history.jsonl")
        if args.what == "run":
            return workflow.Runner(root).run(workflow.WORKFLOWS[args.name])
        shown = sorted(workflow.WORKFLOWS) if args.what == "list" else history.last(args.last) if args.what == "history" else [history.status(args.name)]
        for r in shown:
            print(json.dumps(r))
        return 0
    if not args.root:
        print("name the tables by --root or ONDOL_ROOT", file=sys.stderr)
        return 2
    return getattr(Commands(args, spark), args.command.replace("-", "_"))()


if __name__ == "__main__":
    sys.exit(main())

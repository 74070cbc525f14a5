"""Commands over the library: ``python -m sparrowgrid COMMAND``. Each prints JSON lines; nothing here reaches a network."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from .functions.canonical import canonical_json


def _spark():
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _now(text: str | None):
    from pyspark.sql import functions as F

    return F.current_timestamp() if text is None else F.lit(text).cast("timestamp")


def _rows(df) -> None:
    """Rows as they come from the executors, one partition at a time."""
    for row in df.toJSON().toLocalIterator():
        print(row)


def _store(args):
    from .store import Store

    return Store(_spark(), args.store)


def profiles(args) -> None:
    from .operators.planner import query_count
    from .sources.exchange import profile_faults, read_profiles

    found = read_profiles(_spark(), args.profiles)
    _rows(query_count(found))
    _rows(profile_faults(found))


def plan(args) -> None:
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from .operators.planner import query_tasks, round_robin
    from .sources.exchange import read_profiles

    spark = _spark()
    places = spark.read.schema("country string, code string, name string, region string, rural boolean").json(args.localities, multiLine=True)
    lane = F.concat_ws(":", "country", "locality_code", "strategy")
    tasks = query_tasks(read_profiles(spark, args.profiles), places).withColumn("lane", lane)
    tasks = tasks.withColumn("index", F.row_number().over(Window.partitionBy("lane").orderBy("language", "template_index", "class", "term_index")) - 1)
    _rows(round_robin(tasks, "lane", "index").filter((F.col("ordinal") >= args.offset) & (F.col("ordinal") < args.offset + args.limit)).orderBy("ordinal"))


def geo_import(args) -> None:
    from .sources.geography import load

    print(canonical_json(load(Path(args.file).read_bytes(), json.loads(Path(args.metadata).read_text()), args.format)))


def geo_resolve(args) -> None:
    from pyspark.sql import functions as F

    from .functions.canonical import name_key
    from .sources.geography import UNITS_SCHEMA, name_index, resolve, revalidate

    catalogue = revalidate(json.loads(Path(args.catalogue).read_text()))
    spark = _spark()
    names = [c.split()[0] for c in UNITS_SCHEMA.split(", ")]
    units = spark.createDataFrame([tuple(u.get(n) for n in names) for u in catalogue["units"]], UNITS_SCHEMA)
    asked = spark.createDataFrame([(args.name, args.region)], "name string, region string")
    _rows(resolve(asked, name_index(units, name_key), name_key(F.col("name")), name_key(F.col("region"))))


def technology(args) -> None:
    from .sources.technology import classify

    print(canonical_json(classify(Path(args.file).read_bytes(), args.content_type, args.origin, json.loads(args.headers) if args.headers else None)))


def inspect_file(args) -> None:
    from .sources.documents import claims

    for row in claims(Path(args.file).read_bytes(), args.content_type, args.origin):
        print(canonical_json(row))


def inspect_channel(args) -> None:
    from .sources.channels import response

    print(canonical_json(response(json.loads(Path(args.binding).read_text()), Path(args.file).read_bytes(), args.content_type, args.origin)))


def ingest(args) -> None:
    from pyspark.sql import functions as F

    from .schemas import OBSERVATION

    store = _store(args)
    rows = store.spark.read.text(args.file).select(F.from_json("value", OBSERVATION, {"mode": "FAILFAST"}).alias("o")).select("o.*")
    _rows(store.ingest(rows, _now(args.now)))


def export(args) -> None:
    _rows(_store(args).export(_now(args.now)))


def candidate(args) -> None:
    _rows(_store(args).candidates().filter(f"candidate_id = '{args.candidate}'" if args.candidate.isalnum() else "false"))


def review(args) -> None:
    store = _store(args)
    proposed = store.spark.createDataFrame([(args.candidate, args.revision, args.status, args.target, args.actor, args.reason)], "candidate_id string, expected_revision long, status string, target_id string, actor string, reason string")
    _rows(store.decide(proposed, _now(args.now)))


def relate(args) -> None:
    from pyspark.sql import functions as F

    store = _store(args)
    row = store.spark.createDataFrame([(args.source, args.target, args.kind, args.evidence, args.actor)], "source_id string, target_id string, kind string, evidence_id string, actor string")
    _rows(store.relate(row.select(F.sha2(F.concat_ws("|", *row.columns), 256).alias("relation_id"), "*", _now(args.now).alias("recorded_at")), _now(args.now)))


def expire(args) -> None:
    print(canonical_json({"evidence_removed": _store(args).expire(_now(args.now))}))


def suppress(args) -> None:
    store = _store(args)
    store.suppress(store.spark.createDataFrame([(args.candidate,)], "candidate_id string"), _now(args.now))


def doctor(args) -> None:
    found = _store(args).doctor()
    print(canonical_json(found))
    sys.exit(int(any(found.values())))


def coverage(args) -> None:
    from pyspark.sql import functions as F

    from .operators import coverage as c
    from .operators import evidence
    from .schemas import CLASSES, KINDS, SOURCE_TYPES

    store, spark = _store(args), _spark()
    live = evidence.live(store.table("evidence"), _now(args.now))
    facts = c.cells(live, {"country": "countries", "class": "classes", "source": "source_type"}, "candidate_id", "evidence_group", "observed_at", {"kind": list(KINDS)})
    axes = [spark.createDataFrame([(v,) for v in values], f"{name} string") for name, values in (("country", args.countries.split(",")), ("class", CLASSES), ("source", SOURCE_TYPES))]
    _rows(c.dense(facts, axes, ["candidates", *[f"kind_{k}" for k in KINDS]], ["evidence_groups"]).orderBy("country", "class", "source"))
    _rows(c.unknown_claims(live, "candidate_id", {"country": F.size("countries") == 0, "vehicle_class": F.size("classes") == 0, "source_type": F.col("source_type") == "unknown", "locality": F.col("locality_code") == ""}))


def schedule(args) -> None:
    from . import agenda

    store, now = _store(args), _now(args.now)
    if args.action == "register":
        print(canonical_json(agenda.register_schedule(store, agenda.load_spec(args.file), args.actor, now)))
    elif args.action in ("pause", "resume"):
        print(canonical_json(agenda.set_paused(store, args.schedule, args.action == "pause", args.actor, args.reason, now)))
    else:
        _rows(agenda.due(store, now) if args.action == "due" else agenda.inspect(store))


def policy(args) -> None:
    from . import agenda

    store, now = _store(args), _now(args.now)
    if args.action == "register":
        print(canonical_json(agenda.register_policy(store, args.policy, agenda.load_spec(args.file), now)))
    elif args.action == "revoke":
        agenda.revoke_policy(store, args.policy, args.actor, args.reason, now)
    else:
        _rows(agenda.check_policies(store, store.spark.createDataFrame([(args.policy, args.checksum)], "policy_ref string, checksum string")))


def work(args) -> None:
    from . import agenda
    from .operators.queue import listing

    store = _store(args)
    if args.action == "requeue":
        agenda.requeue(store, args.keys.split(","), args.reason)
    elif args.action == "release":
        print(canonical_json({"released": agenda.release(store, args.limit)}))
    else:
        _rows(listing(store.table("tasks"), args.limit, args.status))


def estimate(args) -> None:
    """Two-group estimate of one stratum from JSON lines of records and of groups."""
    from .operators.estimation import estimate_stratum

    spark = _spark()
    stratum = json.loads(args.stratum)
    fields = ", ".join(f"`{k}`: string" for k in stratum)
    records = spark.read.schema(f"entity_id string, identity_status string, review_status string, source_id string, evidence_ref string, observed_at timestamp, expires_at timestamp, stratum struct<{fields}>").json(args.records)
    groups = spark.read.schema("id string, sources array<string>, independent boolean, evidence_ref string, observed_at timestamp, expires_at timestamp, depends_on array<string>").json(args.groups)
    _rows(estimate_stratum(records, groups, stratum, _now(args.now), _now(args.start), _now(args.end)))


COMMANDS = {
    "profiles": (profiles, "profiles"), "plan": (plan, "profiles localities limit:int=1000 offset:int=0"), "geo-import": (geo_import, "file metadata format=json"), "geo-resolve": (geo_resolve, "catalogue name region="),
    "technology": (technology, "file origin content-type headers="), "inspect-file": (inspect_file, "file origin content-type"), "inspect-channel": (inspect_channel, "file binding origin content-type"),
    "ingest": (ingest, "store file now="), "coverage": (coverage, "store countries=ES,FR,DE,NL,BE,CH now="), "candidate": (candidate, "store candidate"), "review": (review, "store candidate status revision:int actor reason target= now="),
    "relate": (relate, "store source target kind evidence actor now="), "export": (export, "store now="), "expire": (expire, "store now="), "suppress": (suppress, "store candidate now="), "doctor": (doctor, "store"),
    "schedule": (schedule, "store action file= schedule= actor= reason= now="), "policy": (policy, "store action policy file= checksum= actor= reason= now="), "queue": (work, "store action=list keys= reason= status= limit:int=100"),
    "estimate": (estimate, "records groups stratum start end now="),
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="sparrowgrid", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, (run, spec) in COMMANDS.items():
        own = commands.add_parser(name)
        own.set_defaults(run=run)
        for item in spec.split():
            head, has_default, default = item.partition("=")
            option, _, kind = head.partition(":")
            convert = int if kind == "int" else str
            own.add_argument(f"--{option}", required=not has_default, type=convert, default=convert(default) if default else None)
    args = parser.parse_args(argv)
    args.run(args)

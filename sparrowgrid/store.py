"""An evidence store in a folder of Parquet: every change writes new versions of the tables it touches, then one manifest.

Readers follow the newest manifest, so they see all of a change or nothing; a writer that lost a race finds the manifest taken and fails.
Tables that are only added to (log, decisions, ledgers) are lists of parts, so a change costs what it adds. There is no update in place and no server: a nested transaction is one change.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.canonical import candidate_key
from .operators import evidence, graph
from .schemas import DECISION, OBSERVATION, RELATION

TABLES = {
    "evidence": f"candidate_id STRING, evidence_id STRING, evidence_key STRING, {OBSERVATION}",
    "decisions": DECISION,
    "relations": RELATION,
    "deletion_ledger": "candidate_key STRING, candidate_id STRING, recorded_at TIMESTAMP",
    "expired_evidence": "evidence_key STRING, expired_at TIMESTAMP",
    "artifacts": "checksum STRING, body BINARY, expires_at TIMESTAMP",
    "suppressed_artifacts": "checksum STRING, suppressed_at TIMESTAMP",
    "log": "kind STRING, entity STRING, recorded_at TIMESTAMP",
    "schedules": "schedule_id STRING, spec STRING, checksum STRING, starts_at TIMESTAMP, interval_seconds LONG, actor STRING",
    "schedule_events": "schedule_id STRING, seq LONG, action STRING, actor STRING, reason STRING, recorded_at TIMESTAMP",
    "generations": "schedule_id STRING, due_at TIMESTAMP, plan_id STRING, tasks_generated LONG, generation_complete BOOLEAN",
    "policies": "policy_ref STRING, checksum STRING, body STRING, recorded_at TIMESTAMP",
    "revocations": "policy_ref STRING, actor STRING, reason STRING, recorded_at TIMESTAMP",
    "plans": "plan_id STRING, total_tasks LONG, offset LONG, next_offset LONG, recorded_at TIMESTAMP",
    "tasks": "task_key STRING, plan_id STRING, payload STRING, status STRING, reason STRING, not_before DOUBLE, channel_page INT, max_pages INT, deferred BOOLEAN",
}
#: Parts of a table that is only added to, before they are joined.
MOST_PARTS = 64
_IDENTITY = [c.split()[0] for c in OBSERVATION.replace("\n", " ").split(",")]


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = spark._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def versions(self) -> tuple[int, dict[str, int]]:
        """(number, table versions) of the newest manifest."""
        folder = self._path("manifest")
        numbers = [int(f.getPath().getName()) for f in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        if not numbers:
            return 0, {}
        text = self.spark.read.text(f"{self.path}/manifest/{max(numbers)}", wholetext=True).first()[0]
        return max(numbers), json.loads(text)

    def table(self, name: str) -> DataFrame:
        parts = self.versions()[1].get(name)
        return self.spark.read.schema(TABLES[name]).parquet(*[f"{self.path}/{name}/{n}" for n in parts]) if parts else self.spark.createDataFrame([], TABLES[name])

    def commit(self, changes: dict[str, DataFrame], added: dict[str, DataFrame] | None = None) -> int:
        """Write the changed tables whole and the rows added to others, then the manifest that makes both visible. A table is the list of its parts; many parts are joined."""
        number, versions = self.versions()
        joined = {name: self.table(name).unionByName(df.select(*self._columns(name))) for name, df in (added or {}).items() if len(versions.get(name, ())) >= MOST_PARTS}
        more = {name: df for name, df in (added or {}).items() if name not in joined}
        for name, df in {**changes, **joined, **more}.items():
            df.select(*self._columns(name)).write.mode("errorifexists").parquet(f"{self.path}/{name}/{number + 1}")
        text = json.dumps(versions | {name: [number + 1] for name in {**changes, **joined}} | {name: [*versions.get(name, ()), number + 1] for name in more})
        # One file, made once: whoever comes second fails here.
        out = self._fs.create(self._path("manifest", str(number + 1)), False)
        out.write(bytearray(text.encode()))
        out.close()
        return number + 1

    def _columns(self, name: str) -> list[str]:
        return self.spark.createDataFrame([], TABLES[name]).columns

    @staticmethod
    def _logged(kind: str, entities: DataFrame, now) -> DataFrame:
        return entities.select(F.lit(kind).alias("kind"), F.col(entities.columns[0]).alias("entity"), now.alias("recorded_at"))

    def ingest(self, observations: DataFrame, now) -> DataFrame:
        """Admit valid observations; all or nothing. Returns what was quarantined, which must be empty for anything to be written."""
        valid, wrong = evidence.validate_observations(observations)
        if wrong.limit(1).count():
            return wrong
        keyed = valid.withColumn("candidate_key", candidate_key(F.col("locator"), F.col("kind")))
        identity = F.sha2(F.to_json(F.struct(*[c for c in _IDENTITY if c not in ("expires_at", "policy_ref")])), 256)
        keyed = keyed.withColumns({"candidate_id": F.col("candidate_key"), "evidence_key": identity, "evidence_id": identity})
        fresh, _ = evidence.admit(keyed, self.table("deletion_ledger"), self.table("expired_evidence"))
        every = self.table("evidence").unionByName(fresh.drop("candidate_key"))
        rest = [c for c in every.columns if c not in ("evidence_key", "expires_at")]
        merged = every.groupBy("evidence_key").agg(F.min("expires_at").alias("expires_at"), F.min_by(F.struct(*rest), "observed_at").alias("_r")).select("evidence_key", "expires_at", "_r.*")
        self.commit({"evidence": merged}, {"log": self._logged("evidence_ingested", fresh.select("candidate_id").distinct(), now)})
        return wrong

    def candidates(self) -> DataFrame:
        """candidate_id, locator, kind, first and last observation, decision and revision; suppressed ones with a blank locator."""
        known = self.table("evidence").groupBy("candidate_id").agg(F.min_by("locator", "observed_at").alias("locator"), F.min("kind").alias("kind"), F.min("observed_at").alias("first_observed_at"), F.max("observed_at").alias("last_observed_at"))
        gone = self.table("deletion_ledger").groupBy("candidate_id").agg(F.max("recorded_at").alias("last_observed_at"))
        none = F.lit(None).cast("timestamp")
        every = known.withColumn("suppressed", F.lit(False)).unionByName(gone.select("candidate_id", F.lit("").alias("locator"), F.lit("unknown").alias("kind"), none.alias("first_observed_at"), "last_observed_at", F.lit(True).alias("suppressed")))
        return evidence.with_decision(every, self.table("decisions"))

    def decide(self, proposed: DataFrame, now) -> DataFrame:
        """Append decisions on the revisions they were made on; returns those refused. Duplicates may not join a cannot-link pair."""
        alive = evidence.live(self.table("evidence"), now).select("candidate_id").distinct()
        accepted, refused = evidence.decide(self.table("decisions"), proposed, alive)
        every = self.table("decisions").unionByName(accepted.withColumn("decided_at", now))
        duplicates = every.groupBy("candidate_id").agg(F.max_by(F.struct("status", "target_id"), "revision").alias("d")).filter("d.status = 'duplicate_candidate'").select(F.col("candidate_id").alias("a"), F.col("d.target_id").alias("b"))
        broken = graph.cannot_link_conflicts(graph.components(duplicates), self.table("relations").filter("kind = 'cannot_link'").select("source_id", "target_id"))
        if broken.limit(1).count():
            return proposed.withColumn("fault", F.lit("violates_cannot_link"))
        self.commit({}, {"decisions": accepted.withColumn("decided_at", now), "log": self._logged("candidate_decided", accepted.select("candidate_id"), now)})
        return refused

    def relate(self, relations: DataFrame, now) -> DataFrame:
        accepted, refused = evidence.relate(relations, self.table("evidence"), self.candidates(), now)
        self.commit({"relations": self.table("relations").unionByName(accepted.select(*self.table("relations").columns)).dropDuplicates(["source_id", "target_id", "kind", "evidence_id"])})
        return refused

    def expire(self, now) -> int:
        """Take out expired evidence and artifacts and leave tombstones; the number of pieces of evidence."""
        kept, gone = evidence.expire(self.table("evidence"), now)
        count = gone.count()
        artifacts = self.table("artifacts").filter(F.col("expires_at") > now)
        self.commit({"evidence": kept, "artifacts": artifacts}, {"expired_evidence": gone.join(self.table("expired_evidence"), "evidence_key", "left_anti")})
        return count

    def suppress(self, ids: DataFrame, now) -> None:
        """Erase candidates from every table and keep them out."""
        out = evidence.suppress(self.table("evidence"), self.table("relations"), self.table("decisions"), self.table("artifacts"), ids)
        entry = ids.select(F.col("candidate_id").alias("candidate_key"), "candidate_id", now.alias("recorded_at"))
        self.commit({
            "evidence": out["evidence"], "relations": out["relations"], "decisions": out["decisions"], "artifacts": out["artifacts"],
        }, {"suppressed_artifacts": out["suppressed_artifacts"].withColumn("suppressed_at", now), "deletion_ledger": entry})

    def put_artifacts(self, bodies: DataFrame) -> None:
        """Bodies (body, expires_at) by content; the earliest expiry counts, suppressed content stays out."""
        hashed = bodies.select(F.sha2("body", 256).alias("checksum"), "body", "expires_at").join(self.table("suppressed_artifacts"), "checksum", "left_anti")
        every = self.table("artifacts").unionByName(hashed)
        self.commit({"artifacts": every.groupBy("checksum").agg(F.first("body").alias("body"), F.min("expires_at").alias("expires_at"))})

    def export(self, now) -> DataFrame:
        """One record for each candidate, or the reason why it is blocked; duplicate chains must end."""
        out = evidence.exportable(self.candidates(), self.table("evidence"), self.table("decisions"), now)
        latest = self.table("decisions").groupBy("candidate_id").agg(F.max_by(F.struct("status", "target_id"), "revision").alias("d")).filter("d.status = 'duplicate_candidate'")
        chains = graph.chain_terminals(out.select(F.col("candidate_id").alias("node")), latest.select(F.col("candidate_id").alias("node"), F.col("d.target_id").alias("target")))
        met = out.join(chains.select(F.col("node").alias("candidate_id"), F.col("status").alias("_chain")), "candidate_id", "left")
        return met.withColumn("blocked", F.coalesce("blocked", F.when(F.col("_chain") != "ok", F.lit("duplicate_chain_invalid")))).drop("_chain").orderBy("candidate_id")

    def doctor(self) -> dict[str, int]:
        """Violations: decisions and relations of candidates that nothing is known of, evidence keys twice."""
        known = self.candidates().select("candidate_id")
        twice = self.table("evidence").groupBy("evidence_key").count().filter("count > 1").count()
        return {
            "decisions_without_candidate": evidence.integrity(self.table("decisions"), known, "candidate_id").count(),
            "relations_without_source": evidence.integrity(self.table("relations"), known, "source_id", "candidate_id").count(), "evidence_keys_twice": twice,
        }

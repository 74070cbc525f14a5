"""Schemas and closed vocabularies of the evidence model."""

from __future__ import annotations

# The vocabularies of claims.
CLASSES = ("car", "lcv", "motorcycle", "motorhome")
KINDS = ("source", "publisher_account", "professional_seller", "point_of_sale", "unknown")
SOURCE_TYPES = ("marketplace", "dealer_owned", "manufacturer_inventory", "auction", "classifieds", "salvage_complete_vehicles", "authorized_aggregator", "unknown")
DECISIONS = ("unreviewed", "accepted", "duplicate_candidate", "rejected", "needs_evidence")
CONTRACT_COUNTRIES = ("ES", "FR", "DE", "NL", "BE", "CH")
RELATION_KINDS = ("possible_same_identity", "cannot_link", "operates", "located_at", "publishes", "inventory_surface", "outbound_link")
TERMINAL = ("done", "cancelled")
ACCESS_MODES = ("open_data", "public_web", "manual_review", "permission_required")
PRESENCE_STATES = ("observed_present", "absence_suspected", "not_observed", "withdrawn")

OBSERVATION = """
    locator STRING, kind STRING, method STRING, method_version STRING, origin_locator STRING, evidence_group STRING,
    observed_at TIMESTAMP, expires_at TIMESTAMP, policy_ref STRING, countries ARRAY<STRING>, classes ARRAY<STRING>, source_type STRING,
    locality_code STRING, locality_country STRING, signals STRING, body_sha256 STRING
"""
TASK = """
    task_key STRING, plan_id STRING, stratum STRING, country STRING, classes ARRAY<STRING>, strategy STRING, kind STRING, locator STRING,
    priority INT, access_mode STRING, payload STRUCT<evidence_group: STRING, source_type: STRING, locality_code: STRING, language: STRING,
    parent_task_key: STRING, planner_ordinal: BIGINT, depth: INT>, status STRING, not_before DOUBLE, lease_until DOUBLE, lease_token STRING,
    attempts INT, reason STRING, created_at TIMESTAMP
"""
DECISION = "candidate_id STRING, revision BIGINT, status STRING, actor_ref STRING, reason STRING, decided_at TIMESTAMP, target_id STRING"
RELATION = "relation_id STRING, source_id STRING, target_id STRING, kind STRING, evidence_id STRING, actor STRING, recorded_at TIMESTAMP"
PAGE = "page_id BIGINT, origin STRING, content_type STRING, headers MAP<STRING, STRING>, body BINARY, observed_at TIMESTAMP"
PARSED = "locator STRING, kind STRING, relation STRING, label STRING, signals STRING"
UNIT = "code STRING, name STRING, region STRING, rural BOOLEAN, aliases ARRAY<STRING>, parent_code STRING, level STRING"
CHANNEL_PAGE = """
    page_id STRING, task_key STRING, adapter STRING, observed_at TIMESTAMP, expires_at TIMESTAMP, body_sha256 STRING, row_count BIGINT,
    complete BOOLEAN, warnings ARRAY<STRING>, continuation_present BOOLEAN
"""
PROFILE = """
    schema_version STRING, country STRING, name STRING, languages ARRAY<STRING>, vehicle_classes ARRAY<STRING>,
    geography STRUCT<code_system: STRING, unit_name: STRING, catalogue_url: STRING, notes: STRING>,
    strategies ARRAY<STRUCT<id: STRING, family: STRING, evidence_group: STRING, priority: INT, access_mode: STRING, source_type: STRING, seed_urls: ARRAY<STRING>,
        query_templates: MAP<STRING, ARRAY<STRING>>, notes: STRING, source_ids: ARRAY<STRING>, vehicle_classes: ARRAY<STRING>>>,
    vocabulary MAP<STRING, MAP<STRING, ARRAY<STRING>>>,
    sources ARRAY<STRUCT<id: STRING, url: STRING, title: STRING, checked_at: STRING, access_notes: STRING>>, blind_spots ARRAY<STRING>, review_days INT
"""
PRESENCE = "id STRING, at BIGINT, scope STRING, kind STRING, complete BOOLEAN, comparable BOOLEAN, present BOOLEAN, verified BOOLEAN"

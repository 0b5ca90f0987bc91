"""Queries of rule profiles: every customer has a record, a good one or one that breaks a rule, by the remainder of its key.

The records are spelled here with the reasons that they should get; SQL states the reasons alone.
"""

from __future__ import annotations

import copy
import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.operators import profiles, rules
from logloom.operators.sizing import spread
from logloom.plans.queries import query, read

Case = tuple[dict[str, Any], str, str]


def changed(base: dict, *changes: tuple[str, Any]) -> dict:
    """``base`` with values put at dotted paths; ``...`` removes the key, and a number is a place in a list."""
    out = copy.deepcopy(base)
    for path, value in changes:
        at, *rest = path.split(".")
        held, keys = out, [at, *rest]
        for key in keys[:-1]:
            held = held[int(key) if isinstance(held, list) else key]
        last = int(keys[-1]) if isinstance(held, list) else keys[-1]
        if value is ...:
            del held[last]
        else:
            held[last] = value
    return out


def case_sql(cases: list[Case]) -> str:
    reasons = lambda i: ", ".join(f"'{c[i]}'" for c in cases)
    return f"SELECT c_custkey, [{reasons(1)}][c_custkey % {len(cases)} + 1] AS drops, [{reasons(2)}][c_custkey % {len(cases)} + 1] AS flags FROM customer"


def judged(s: SparkSession, d: str, profile: str, cases: list[Case]) -> DataFrame:
    assert profile in rules.PROFILES and profiles  # the latter registers its own
    texts = F.array(*[F.lit(json.dumps(c[0])) for c in cases])
    record = F.replace(F.element_at(texts, (F.col("c_custkey") % len(cases) + 1).cast("int")), F.lit("@USER"), F.col("c_name"))
    rows = rules.check(spread(read(s, d, "customer").select("c_custkey", "c_name"), "c_custkey").select("c_custkey", record.alias("record")), "record", profile)
    return rows.select("c_custkey", F.array_join("drops", ",").alias("drops"), F.array_join("flags", ",").alias("flags"))


def register(profile: str, name: str, cases: list[Case]) -> Callable:
    def run(s: SparkSession, d: str) -> DataFrame:
        return judged(s, d, profile, cases)

    return query(name, case_sql(cases))(run)


def detail(key: str, level: str, strength: str = "strong") -> dict:
    return {"area": "a", key: level, "evidence": "e", "signal_strength": strength}


AFFINITY = {
    "shopping": {"product_categories": [{"category": "Apparel", "description": "shoes"}], "shopper_type": {"value": ["DealDriven"], "details": [detail("type", "DealDriven")]}},
    "dining": {"restrictions": {"value": ["Unknown"], "details": []}},
}
ASKED = {"user_id": "@USER", "commercial_interests": [{"interest_name": "Tea"}], "non_commercial_interest_names": ["Art"], "life_stage": {"value": "single"}}
DEAL = {"input": ASKED, "output": {"deal_seeking": {"value": "high", "details": [detail("seeking", "high")]}, "price_tier": {"value": "mid", "details": [detail("tier", "mid")]}, "affinity": AFFINITY}}
LEVEL = {"input": ASKED, "output": {n: {"value": "Medium", "details": [detail(k, "Low"), detail(k, "High")]} for n, k in profiles.SENSITIVITIES.items()} | {"affinity": AFFINITY}}
BAD_INPUTS: list[tuple[tuple, str, str]] = [
    ((("input.commercial_interests", []),), "invalid_input", ""), ((("input.non_commercial_interest_names", [" "]),), "invalid_input", ""), ((("input.life_stage", "single"),), "invalid_input", ""),
    ((("input.non_commercial_interest_names", ["TEA "]),), "", "duplicate_input_name"),
]
BAD_AFFINITIES: list[tuple[tuple, str, str]] = [
    ((("output.affinity.shopping.shopper_type.value", ["ValueDriven"]),), "inconsistent_content", ""), ((("output.affinity.dining.restrictions.value", ["Unknown", "Vegan"]),), "inconsistent_content", ""),
    ((("output.affinity.dining.restrictions.value", ["Vegan"]), ("output.affinity.dining.restrictions.details", [detail("restriction", "Vegan")])), "", ""),
    ((("output.affinity.shopping.product_categories", [{"category": "Apparel", "description": "x"}] * 2),), "inconsistent_content", ""), ((("output.affinity.shopping.product_categories", []),), "", "empty_product_categories"),
    ((("output.affinity.shopping.product_categories.0.category", "Shoes"),), "json_format", ""), ((("output.affinity.shopping.product_categories.0.description", "for @USER"),), "text_quality", ""),
    ((("output.affinity.dining", ...),), "json_format", ""), ((("output.affinity.dining.restrictions.value", []),), "json_format", ""), ((("output", None), ("input.commercial_interests", None)), "invalid_input,json_format", ""),
]


def variants(base: dict, changes: list[tuple[tuple, str, str]]) -> list[Case]:
    return [(base, "", ""), *[(changed(base, *c), drops, flags) for c, drops, flags in changes]]


register("preference", "c10_preference", variants(DEAL, [
    *BAD_INPUTS, *BAD_AFFINITIES,
    ((("output.deal_seeking.value", "unknown"),), "inconsistent_content", ""), ((("output.deal_seeking.details", []),), "inconsistent_content", "weak_evidence"), ((("output.deal_seeking.value", "low"),), "inconsistent_content", ""),
    ((("output.deal_seeking.details", [detail("seeking", "high"), detail("seeking", "low")]),), "inconsistent_content", ""), ((("output.deal_seeking.value", "medium"), ("output.deal_seeking.details", [detail("seeking", "high"), detail("seeking", "low")])), "", ""),
    ((("output.deal_seeking.details", [detail("seeking", "high", "weak")]),), "", "weak_evidence"), ((("output.price_tier.value", "premium"), ("output.price_tier.details", [detail("tier", "premium")])), "", "weak_evidence"),
    ((("output.price_tier.details", [detail("tier", "budget")]),), "", "weak_evidence"), ((("output.deal_seeking.details.0.more", 1),), "json_format", ""), ((("output.price_tier", dict(reversed(DEAL["output"]["price_tier"].items()))),), "json_format", ""),
]))
register("preference_v2", "c10_preference_v2", variants(LEVEL, [
    *BAD_INPUTS, *BAD_AFFINITIES, ((("input.life_stage", {}),), "invalid_input", ""),
    ((("output.discount_sensitivity.details", []),), "inconsistent_content", ""), ((("output.price_sensitivity.value", "Unknown"),), "inconsistent_content", ""), ((("output.price_sensitivity", {"value": "Unknown", "details": []}),), "", ""),
    ((("output.subscription_affinity.details", [detail("affinity", "High")]),), "inconsistent_content", ""), ((("output.subscription_affinity.details", [detail("affinity", "High"), detail("affinity", "Medium")]),), "", ""),
]))

STAGE = {"value": "single", "confidence": "high", "evidence": ["lives alone"]}
PERSON = {"user_id": "@USER", "active_interests": [{"interest_name": "Tea"}], "facts": {}}
TOLD = {"input": PERSON, "output": {"life_stage": STAGE, "biography": "Likes tea."}}
BAD_PEOPLE: list[tuple[tuple, str, str]] = [
    ((("input.active_interests", []),), "invalid_input", ""), ((("input.active_interests", [{"interest_name": ""}]),), "invalid_input", ""), ((("input.active_interests", [{"interest_name": "Tea"}, {"interest_name": " tea"}]),), "", "duplicate_input_name"),
    ((("output.life_stage.value", "rich"),), "json_format", ""), ((("output.life_stage.evidence", []),), "json_format", ""), ((("output.biography", " "),), "json_format", ""), ((("output.biography", "Likes tea.}"),), "text_quality", ""),
    ((("output.biography", "Knows @USER."),), "text_quality", ""), ((("output.life_stage.evidence", ["Alone", "alone "]),), "inconsistent_content", ""), ((("output.life_stage.evidence", ['"value": 1']),), "text_quality", ""),
]
register("biography", "c8_biography", variants(TOLD, [
    *BAD_PEOPLE, ((("output.biography", "She likes tea."),), "", "unsupported_claim"), ((("output.biography", "She likes tea."), ("input.facts.gender", "Female")), "", ""),
    ((("output", dict(reversed(TOLD["output"].items()))),), "json_format", ""), ((("output.age", 3),), "json_format", ""),
]))


def said(value: str = "Unknown", source: str = "unknown", evidence: tuple = (), **first: Any) -> dict:
    return first | {"evidence": list(evidence), "value": value, "confidence": "low", "confidence_score": 0.5, "source": source}


AGE = {k: False for k in profiles.SIGNALS} | {"later_life_clusters": [], "early_adult_events": []}
HELD = {a: said() for a in profiles.ATTRIBUTES} | {"age_group": said(signals=AGE), "gender": said(lean={"male": [], "female": []})}
PEOPLE = {"input": PERSON | {"declared_attributes": {}}, "output": {"life_stage": STAGE, "user_attributes": HELD, "biography": "Likes tea."}}
AT = "output.user_attributes"
WORK = {"titles": ["Senior Engineer"], "companies": ["Acme Works"], "fieldOfStudy": [], "seniorities": ["senior"], "profile_geo": "Lyon, Rhône, France"}
LINKED = (("input.facts.linkedin_profile", WORK), (f"{AT}.age_group.signals", AGE | {"linkedin_min_age": 30}))
register("biography_v2", "c9_biography_v2", variants(PEOPLE, [
    *BAD_PEOPLE, (((f"{AT}.company", said("Acme", "behavioral_inference")),), "unknown_mismatch", ""),
    (((f"{AT}.company", said("Acme", "behavioral_inference", ["reads"])),), "", ""), (((f"{AT}.company", said("Unknown", "behavioral_inference")),), "unknown_mismatch", ""), (((f"{AT}.company", said("Acme", "linkedin", ["x"])),), "source_mismatch", ""),
    ((*LINKED, (f"{AT}.company", said("ACME", "linkedin", ["x"]))), "", ""), ((*LINKED, (f"{AT}.company", said("Globex", "linkedin", ["x"]))), "", "fact_copy_mismatch"), ((*LINKED, (f"{AT}.education_area", said("Law", "linkedin", ["x"]))), "linkedin_field_missing", ""),
    ((*LINKED, (f"{AT}.occupation", said("Engineer", "linkedin", ["x"]))), "", ""), ((*LINKED, (f"{AT}.occupation", said("Retired", "linkedin", ["x"]))), "", ""), ((*LINKED, (f"{AT}.career_stage", said("Manager", "linkedin", ["x"]))), "", "fact_copy_mismatch"),
    ((*LINKED, (f"{AT}.career_stage", said("Senior Professional", "linkedin", ["x"]))), "", ""), ((*LINKED, (f"{AT}.home_location", said("Lyon, Rhone, FR", "linkedin", ["x"]))), "", ""), ((*LINKED, (f"{AT}.home_location", said("Paris, FR", "linkedin", ["x"]))), "", "fact_copy_mismatch"),
    ((("input.facts.location_data", {"current_location": "Oslo, Norway", "place_frequency": [{"place": "Bergen"}]}), (f"{AT}.home_location", said("Bergen, NO", "location_data", ["x"]))), "", ""), ((("input.facts.linkedin_profile", WORK),), "source_mismatch", ""),
    ((("input.declared_attributes", {"gender": "Female"}), (f"{AT}.gender", said("Female", "declared", ["x"], lean={"male": [], "female": []}))), "", ""), ((("input.declared_attributes", {"gender": "Female"}),), "declared_mismatch", ""),
    ((("input.declared_attributes", {"age_group": "65+"}), (f"{AT}.age_group", said("65+", "declared", ["x"]))), "", ""), (((f"{AT}.age_group", said()),), "declared_mismatch", ""),
    (((f"{AT}.gender", said("Female", "behavioral_inference", ["x"], lean={"male": [], "female": ["x"]})), ("output.biography", "He likes tea.")), "inconsistent_content", ""), (((f"{AT}.gender", said()),), "json_format", ""),
    (((f"{AT}.company.evidence", ["a", "b", "c", "d"]),), "json_format", ""), (((f"{AT}.company.confidence_score", 1.5),), "json_format", ""), (((f"{AT}.age_group.signals", dict(reversed(AGE.items()))),), "json_format", ""), (((f"{AT}.age_group", said() | {"signals": AGE}),), "json_format", ""),
]))

BLOCKS = "### Source interest 1: Tea\n- Brands: Leaf, Pot Co\n- Existing queries:\n  - green tea\n  - black tea\n- Other\n  - no query\n### Source interest 2: Cups\n- Existing queries:\n  - blue cups\n"
ASK = {"query": "green tea near me", "value_type": "refine", "source_query_refs": ["green tea"], "delta_source": "source_interest", "delta_evidence": "x", "decision_change": "y"}
PLAN = {"input_mission_name": "Buy tea", "mission_name": "Tea", "source_interests": ["Tea"], "scenarios": ["shopping"], "predicted_brands": ["Kettle"], "predicted_queries": [ASK], "enrichment_sources": []}
ADDED = {"input": {"user_id": "@USER", "candidate_missions": [{"mission_name": "Buy tea", "source_interests": ["Tea", "Cups"]}], "source_evidence": BLOCKS, "query_language": "en"}, "output": {"geo_resolution": {}, "enhanced_missions": [PLAN]}}
M, Q = "output.enhanced_missions.0", "output.enhanced_missions.0.predicted_queries.0"
register("enhancement", "c12_mission_enhancement", variants(ADDED, [
    ((("output.enhanced_missions", []),), "", "no_enhanced_mission"), ((("input.source_evidence", ""), ("output.enhanced_missions", [])), "invalid_input", "no_enhanced_mission"), ((("input.candidate_missions", []), ("output.enhanced_missions", [])), "invalid_input", "no_enhanced_mission"),
    (((f"{M}.input_mission_name", "Other"),), "inconsistent_content", ""), (((f"{M}.source_interests", ["Pans"]), (f"{Q}.source_query_refs", [])), "inconsistent_content", ""), (((f"{M}.source_interests", ["Cups"]),), "inconsistent_content", ""),
    (((f"{M}.source_interests", ["Tea", "Cups"]), (f"{Q}.source_query_refs", ["blue cups", "black tea"])), "", ""), (((f"{Q}.source_query_refs", ["no query"]),), "inconsistent_content", ""), (((f"{M}.predicted_brands", [" pot co"]),), "inconsistent_content", ""),
    (((f"{Q}.query", "Green Tea"),), "inconsistent_content", "uppercase_query"), (((f"{M}.predicted_queries", [ASK, ASK]),), "inconsistent_content", ""), (((f"{Q}.query", "tea"),), "text_quality", ""), (((f"{Q}.query", "tea"), ("input.query_language", "ja")), "", ""),
    (((f"{Q}.query", "where is tea?"),), "text_quality", ""), (((f"{Q}.decision_change", "@USER asked"),), "text_quality", ""), (((f"{M}.scenarios", []),), "json_format", ""), (((f"{M}.predicted_queries", []),), "json_format", ""),
    ((("output", {"enhanced_missions": [], "geo_resolution": {}}),), "json_format", ""), ((("output.more", 1),), "json_format", ""), (((f"{M}.predicted_queries", [dict(reversed(ASK.items()))]),), "json_format", ""), (((f"{M}.predicted_brands", ["a", "b", "c", "d"]),), "json_format", ""),
]))

"""Queries of functions and rules over written cases: every part takes the case that its key falls on.

Each table below has what is given and what must come out, with a case for every branch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import geo
from quernstone.functions import lexicon as L
from quernstone.functions import numbers as N
from quernstone.functions import text as T
from quernstone.operators import entities, passages, profiles, quality
from quernstone.plans.registry import query
from quernstone.session import load


def _lit(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''").replace("\x00", "' || chr(0) || '") + "'"
    return str(value)


def cycled(spark: SparkSession, sf: str, *givens: list) -> tuple[DataFrame, list[Column]]:
    """Parts, and for each list of givens the one that a part's key falls on."""
    chosen = [F.get(F.array(*map(F.lit, g)), F.pmod("p_partkey", F.lit(len(g))).cast("int")) for g in givens]
    return load(spark, sf, "part").select("p_partkey"), chosen


def cases(name: str, wants: list, column: str, kind: str, *givens: list):
    """Registers a function of the given columns; its result is `column`, cast to `kind`."""
    sql = f"SELECT p_partkey, CAST(list_extract([{', '.join(map(_lit, wants))}], (p_partkey % {len(wants)})::INT + 1) AS {kind}) AS {column} FROM part"

    def add(fn: Callable[..., Column]):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            parts, chosen = cycled(spark, sf, *givens)
            return parts.select("p_partkey", fn(*chosen).cast({"VARCHAR": "string", "DOUBLE": "double", "INT": "int", "BIGINT": "long", "BOOLEAN": "boolean"}[kind]).alias(column))

        query(name, sql)(run)
        return fn

    return add


cases("fn_norm_quote", ["alpha beta-gamma", "a/b,c", "the data centres will", "first point", "3.5mw(net);ok"], "q", "VARCHAR", ["“Alpha”  beta – Gamma", "a / b , c", "The data centre s will", "• First\n point", "3 . 5MW (net) ; OK"])(T.norm_quote)
cases("fn_quote_fragments", ["alpha beta|gamma|delta", "", "whole, quote", "x"], "parts", "VARCHAR", ["(“alpha beta) … gamma, ... delta.”", "… ....", "whole, quote!", "...x..."])(lambda c: F.array_join(T.quote_fragments(c), "|"))
cases("fn_area_to_sqm", [2500.0, 92.903, None, 40.0, None], "sqm", "DOUBLE", [2500.0, 1000.0, 12.0, 40.0, 7.0], [" SQM ", "sqft", "acres", "Square Metres", None])(lambda v, u: F.round(N.to_sqm(v, u), 6))
cases("fn_sig4", [123500.0, 0.0001235, 9.877, 0.0, -45680.0, 1.0, None], "v", "DOUBLE", [123456.0, 0.000123467, 9.87654, 0.0, -45678.0, 1.0, None])(lambda v: F.round(N.sig4(v), 9))
cases("fn_clean_filename", ["a b c .pdf", "x y", "z" * 80, "", "plain.doc"], "name", "VARCHAR", ['a/b:c*?"<>|.pdf', "  x   y. .", "z" * 100, "???", "plain.doc"])(T.clean_filename)
cases("fn_tidy_case", ["Erection of a data centre (phase 1)", "Erection of Hall B", "", "12 units", "Mixed Case KEPT"], "t", "VARCHAR", ["ERECTION OF A DATA CENTRE (PHASE 1", " erection of Hall B", None, "12 UNITS", "mixed Case KEPT"])(T.tidy_case)
cases("fn_coerce_page", [7, 12, None, None, 3], "page", "INT", ["[PAGE 7]", "p 12 of 30", "none", None, "3"])(T.coerce_page)
cases("fn_nul_strip", ["ab", "c", None, ""], "t", "VARCHAR", ["a\x00b", "c", None, "\x00"])(T.nul_strip)
cases("fn_strip_xml", ["Alpha\nB&C\n", "cell|", "x < y"], "t", "VARCHAR", ["<w:p><w:t>Alpha</w:t></w:p><w:p>B&amp;C</w:p>", "<table:table-cell>cell</table:table-cell>|", "x &lt; y"])(T.strip_xml)
cases("fn_desc_forms", [True, True, True, False, True, False], "there", "BOOLEAN", ["A load of 30 MW.", "30MW in all", "rated 3.5  MVA", "300 MW", "4 units", "thirty MW"], [30.0, 30.0, 3.5, 30.0, 4.0, 30.0], ["MW", "mw", "MVA", "MW", "units", "MW"])(T.value_in_text)
cases("fn_dc_relevant", [True, True, False, False], "relevant", "BOOLEAN", ["A Data Centre", "server hall", "houses", None])(lambda c: F.size(T.keyword_hits(c, ["data centre", "server"])) > 0)
cases("fn_parse_entity", ["Acme", "Savills", "City Council of Leeds", None, "Arup", "AECOM", "Jones", None], "name", "VARCHAR", ["Agent: Acme", "Nick Heard of Savills", "consultee: City Council of Leeds", "the applicant", "Report prepared by Arup (London)", "AECOM submitted the plans", "Jones, acting as the agent", " - "])(lambda c: entities.display_name(c)["display"])
cases("fn_is_authority", [False, False, True, False, True, True, False], "body", "BOOLEAN", ["Agent: Acme", "Nick Heard of Savills", "Leeds City Council", "the applicant", "prepared by Historic England", "London Borough of Ealing", "Councillors Ltd"])(lambda c: entities.display_name(c)["is_authority"])
cases("txt_kind_from_name", ["Committee Report", "Flood - Risk", "Site plan", "noext", "Plan", "12", "Decision Notice"], "kind", "VARCHAR", ["COMMITTEE_REPORT-12.pdf", "Flood_-_Risk.doc", "Site plan-3.pdf", "noext", "PLAN.pdf", "12-3.pdf", "DECISION NOTICE-4.docx"])(profiles.kind_from_name)
cases("jn_authority_name", [True, True, False, True, True, False, True], "same", "BOOLEAN", ["Leeds City Council", "Buckinghamshire", "Leeds", "", "London Borough of Ealing", "Kent", "North Yorkshire County"], ["leeds", "Bucks (north)", "Bristol", "anything", "Ealing Council", "Kentish Town", "North Yorks"])(T.same_authority)
cases("gr_bucket", ["fossil", "fossil", "renewable", "other", "biomass_waste", "nuclear", "storage", "other"], "bucket", "VARCHAR", [" Gas;Oil ", "coal", "wind", None, "Landfill_Gas", "NUCLEAR", "battery", "fusion"])(profiles.plant_bucket)
cases("txt_portal_family", ["idox", "ocella", "agile", "ni_planning", "arcus", "nec", "northgate", "salesforce", "nec", "bespoke/other", "no_url", "no_url"], "family", "VARCHAR", ["https://a/Online-Applications/x", "http://b/OcellaWeb/planningDetails?r=1", "https://planning.agileapplications.co.uk/x", "https://planningsystemni.gov.uk", "https://x/planning/display/1", "https://x/assure/1", "http://x/StdDetails.aspx", "https://x/pr/s/detail/1", "https://lpassure.x", "https://y", None, ""])(T.portal_family)
cases("txt_power_context", ["ev_charging", "intensity_target", "building_services", "onsite_renewables", "standby_generation", "grid_connection", "unclassified"], "context", "VARCHAR", ["7 kW chargers", "90 kWh/m2", "a heat pump of 5 kW", "20 kWp solar", "a diesel genset", "import from the grid", "30 MW"])(lambda c: L.power_context(c)["context"])
cases("txt_power_flagged", [False, False, False, False, True, True, True], "flagged", "BOOLEAN", ["7 kW chargers", "90 kWh/m2", "a heat pump of 5 kW", "20 kWp solar", "a diesel genset", "import from the grid", "30 MW"])(lambda c: L.power_context(c)["flagged"])
cases("txt_family_for", [
    "party_applicant", "party_adviser", "party_authority", "party_other", "power_generation", "power_grid", "power_demand", "energy_efficiency_heat", "cooling", "water", "flood_drainage", "designated_sites", "ecology_biodiversity",
    "air_quality_emissions", "noise", "land_quality", "waste", "transport_access", "socioeconomic", "permits_regulatory", "construction_operation", "eia_process", "development_scale", "application_admin", "site_identity", "unclassified",
], "family", "VARCHAR", [
    "Applicant_name", "planning_consultant", "consultee", "stakeholder", " Diesel_storage", "substation", "it_load", "solar_panels", "chiller_type", "potable_supply", "flood_zone", "ancient_woodland", "bat_survey",
    "nox_level", "acoustic_barrier", "asbestos", "recycling_rate", "hgv_movements", "jobs_created", "permit_held", "fencing", "screening_opinion", "storey_count", "decision_date", "ward", "zzz",
])(L.family_for)
cases("txt_character_rules", ["standalone_datacentre", "ancillary_server_room", "institutional_facility", "telecoms_facility", "standalone_datacentre", "enabling_infrastructure", "unclear", "unclear"], "character", "VARCHAR", ["Erection of a new data centre", "a server room in the basement", "university hall", "telephone exchange", "colocation space", "a substation and cable route", "a shed", None])(L.character_for)
cases("txt_doc_tier", ["A", "skip", "A", "C", "B", "B"], "tier", "VARCHAR", ["Section 106 drawing", "Proposed elevation", "Flood risk assessment", "letter of objection", "other letter", None])(lambda c: L.kind_tier(c)["tier"])
cases("txt_routes", ["Barbour ABI;Keyword search", "Planning Inspectorate", "", "Next to a known site;Operator watch-list", "Curated cohort;Parent application;Duplicate record;Reviewed and excluded", "Energy search near a site"], "routes", "VARCHAR", ["barbour:7,dc_keyword,barbour:8", "nsip_energy,nsip_register", "zzz", "spatial:A/1,operator:x", "cohort:y,parent_backfill:B,duplicate_of:C,exclude:d", "energy_national:q"])(lambda c: F.array_join(L.routes(F.split(c, ",")), ";"))
cases("txt_large_flag", [True, False, False], "large", "BOOLEAN", [400_000, 399_999, 0])(lambda n: passages.is_large(n, 400_000))
#: The published control point of the grid.
cases("fn_osgb_to_wgs84", ["52.658 1.716"], "place", "VARCHAR", [651409.903], [313177.270])(lambda e, n: F.concat_ws(" ", *[F.format_string("%.3f", geo.grid_to_wgs84(e, n)[c]) for c in ("lat", "lon")]))


@query(
    "fn_finding_key",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN 'n:' || l_orderkey || ':' || l_quantity::BIGINT || ':mw' ELSE 'q:' || l_orderkey || ':said ' || lower(l_returnflag) || ' ' || l_linenumber END AS k FROM lineitem",
)
def finding_key(spark: SparkSession, sf: str) -> DataFrame:
    """Findings with a figure are keyed by it, others by their quote."""
    number = F.when(F.col("l_returnflag") == "N", F.col("l_quantity"))
    quote = F.concat(F.lit("Said: "), F.col("l_returnflag"), F.lit(" -- "), F.col("l_linenumber").cast("string"))
    key = T.finding_key(F.col("l_orderkey"), number, F.lit(" MW "), quote)
    shown = F.when(key["number"].isNotNull(), F.concat_ws(":", F.lit("n"), key["doc"].cast("string"), key["number"].cast("long").cast("string"), key["unit"])).otherwise(F.concat_ws(":", F.lit("q"), key["doc"].cast("string"), key["quote"]))
    return load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", shown.alias("k"))


_REPLIES = ['```json\n{"findings":[{"a":1}]}\n```', "[]", '{"findings":[{"a":1},{"b":', "none", None, 'Here: {"findings": [{"x": {"y": 2}}, {"z": "}"}]} done', '[{"a":1}, 5, {"b":2}]', '{"other": [{"a": 1}]}']


@query("txt_salvage", "SELECT p_partkey, list_extract([1, 0, NULL, NULL, NULL, 2, 3, NULL], (p_partkey % 8)::INT + 1)::BIGINT AS parsed, list_extract([1, 0, 1, 0, 0, 2, 2, 1], (p_partkey % 8)::INT + 1)::BIGINT AS salvaged FROM part")
def salvage(spark: SparkSession, sf: str) -> DataFrame:
    """Replies that are whole, fenced, cut short, none at all, with words around them, and of another shape."""
    parts, (raw,) = cycled(spark, sf, _REPLIES)
    r = passages.parsed_replies(parts.select("p_partkey", raw.alias("raw")))
    return r.select("p_partkey", F.when(F.col("parsed").isNotNull(), F.size("parsed")).cast("long").alias("parsed"), F.size("salvaged").cast("long").alias("salvaged"))


@query(
    "txt_best_clause_cases",
    """
    SELECT p_partkey, list_extract(['Erection of a data centre of ' || p_size || ',000 sqm with substation', 'Installation of ' || p_size || ' generators and a battery compound', 'Construction of a technology park of ' || p_size || ' hectares', NULL, 'Variation of condition ' || p_size || ' of an older permission'], (p_partkey % 5)::INT + 1) AS clause FROM part WHERE p_partkey % 5 <> 3
    """,
)
def best_clauses(spark: SparkSession, sf: str) -> DataFrame:
    """Descriptions of several clauses: what is built against what is discharged, demolished or cited; two rows for each second part."""
    k, n = F.col("p_partkey") % 5, F.col("p_size").cast("string")
    said = (
        F.when(k == 0, F.concat(F.lit("Discharge of condition 20 pursuant to 14/1190/OUT; Erection of a data centre of "), n, F.lit(",000 sqm with substation - amended plans received")))
        .when(k == 1, F.concat(F.lit("Non-material amendment to the approved layout: Installation of "), n, F.lit(" generators and a battery compound")))
        .when(k == 2, F.concat(F.lit("Demolition of the existing building on the land. Construction of a technology park of "), n, F.lit(" hectares")))
        .when(k == 3, F.lit("too short"))
        .otherwise(F.concat(F.lit("Variation of condition "), n, F.lit(" of an older permission")))
    )
    p = load(spark, sf, "part").select("p_partkey", F.explode(F.when(F.col("p_partkey") % 2 == 0, F.array(F.lit("Approval of details under condition 7 of the permission"), said)).otherwise(F.array(said))).alias("said"))
    p = p.where((k != 4) | (F.col("said") != "Approval of details under condition 7 of the permission")).where((k != 3) | (F.col("said") == "too short"))
    return passages.best_clause(p, "p_partkey", "said").select("p_partkey", "clause")


_RULES = ["energy_not_power", "storage_not_generation", "thermal_not_electrical", "thermal_output_not_electrical", "headerless_table_row", "temporary_supply", "equipment_label_not_connection", "contradicted_by_own_document"]


@query("dq_demote_rules", f"SELECT p_partkey, list_extract([{', '.join(_lit('[' + r + ']') for r in _RULES)}, '', ''], (p_partkey % 10)::INT + 1) AS mark, p_partkey % 10 IN (1, 2, 3, 9) AS site FROM part")
def demote_rules(spark: SparkSession, sf: str) -> DataFrame:
    """One figure for each correction rule, one that no rule changes, and one that is no capacity at all."""
    electrical, grid = "onsite_generation", "grid_connection"
    quantity = ["it_load", electrical, "it_load", "it_load", "it_load", grid, grid, "it_load", "it_load", "it_load"]
    value = [5000.0, 20.0, 30.0, 800.0, 12.0, 10.0, 10.0, 2240.0, 30.0, 30.0]
    said = ["annual", "a battery of 20 MW", "thermal input of 30 MW", "thermal output of 800 MW and 300 MWe", "12 34 56 78 90", "a temporary supply", "as on the floor plan", "will contribute about 2240 MW", "IT load of 30 MW for the new halls", "IT load of 30 MW for the new halls"]
    parts, (q, v, s) = cycled(spark, sf, quantity, value, said)
    none = F.lit(None).cast("string")
    verdict = F.when(F.col("p_partkey") % 10 == 8, "not_capacity").otherwise("site_capacity")
    df = parts.select("p_partkey", verdict.alias("verdict"), q.alias("quantity_type"), v.alias("value_mw"), s.alias("evidence"), F.lit("x").alias("signal_type"), none.alias("unit_note"))
    out = quality.corrected(df, quality.capacity_rules())
    return out.select("p_partkey", F.regexp_extract(F.coalesce("unit_note", F.lit("")), r"\[\w+\]", 0).alias("mark"), (F.col("verdict") == "site_capacity").alias("site"))


@query(
    "dq_validate_matches",
    """
    WITH m AS (SELECT p_partkey AS k, p_partkey % 6 AS c FROM part)
    SELECT k AS claim_id, CASE c WHEN 1 THEN 'unknown claim' WHEN 2 THEN 'renamed claim' WHEN 3 THEN 'confidence' WHEN 4 THEN 'evidence too short' ELSE 'company-level claim' END AS "check" FROM m WHERE c <> 0
    """,
)
def validate_matches(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    p = load(spark, sf, "part").select("p_partkey", "p_name")
    claims = p.where(k % 6 != 1).select(k.alias("claim_id"), F.col("p_name").alias("claim_name"))
    evidence = F.when(k % 6 == 4, "short").otherwise("the operator's page names the site and its figure in one sentence")
    matches = p.select(k.alias("claim_id"), F.when(k % 6 == 2, "another").otherwise(F.col("p_name")).alias("claim_name"), F.when(k % 6 == 3, "Z").otherwise("A").alias("confidence"), evidence.alias("evidence"), F.when(k % 6 == 5, "company").alias("level"))
    return quality.match_checks(matches, claims)


@query("dq_assert_count", "SELECT count(*) AS n FROM nation")
def counted(spark: SparkSession, sf: str) -> DataFrame:
    n = load(spark, sf, "nation")
    return quality.assert_columns(quality.assert_count(n, 25, "nations"), ["n_nationkey", "n_name", "n_regionkey"]).agg(F.count("*").alias("n"))


_COOLING = [("a chiller", "Water-cooled / chilled water"), ("a dry cooler", "Air-cooled"), ("adiabatic units", "Adiabatic / evaporative"), ("free air", "Free cooling"), ("district heat", "Heat reuse / offtake"), ("a closed-loop system", "Closed loop"), ("liquid cooling", "Immersion / liquid"), ("nothing", None)]


@query(
    "txt_cooling",
    f"""
    WITH t AS (SELECT user_id AS site, list_extract([{", ".join(_lit(w) for _, w in _COOLING)}], (event_id * event_id % 8)::INT + 1) AS label FROM events),
    c AS (SELECT site, label, count(*) AS n FROM t WHERE label IS NOT NULL GROUP BY ALL),
    r AS (SELECT *, row_number() OVER w AS rn, first_value(n) OVER w AS top FROM c WINDOW w AS (PARTITION BY site ORDER BY n DESC, label)),
    major AS (SELECT site, string_agg(label || ' (' || n || CASE WHEN rn = 1 THEN ' mentions)' ELSE ')' END, ', ' ORDER BY rn) AS line FROM r WHERE rn = 1 OR n >= top * 0.2 GROUP BY site),
    minor AS (SELECT site, string_agg(label, ', ' ORDER BY rn) AS line FROM r WHERE rn > 1 AND n < top * 0.2 GROUP BY site)
    SELECT site, major.line || coalesce('; also referenced: ' || minor.line, '') AS label FROM major LEFT JOIN minor USING (site)
    """,
)
def cooling(spark: SparkSession, sf: str) -> DataFrame:
    said = F.get(F.array(*[F.lit(s) for s, _ in _COOLING]), (F.col("event_id") * F.col("event_id") % 8).cast("int"))
    return profiles.cooling_profile(load(spark, sf, "events").select(F.col("user_id").alias("site"), said.alias("text")))

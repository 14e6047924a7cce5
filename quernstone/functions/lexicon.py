"""Lexicons and ordered rules over text, as column expressions.

Fixed values: the terms and patterns in this module are the vocabulary that the results
rest on. Rules are ordered; the first that fits decides.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Subjects and their terms.
SUBJECTS = {
    "water": ["cooling water", "water cooling", "water abstraction", "abstraction", "water use", "water consumption", "potable water", "grey water", "closed loop", "evaporative cooling", "adiabatic", "discharge consent", "trade effluent", "effluent", "surface water discharge"],
    "air": ["air quality", "emissions", "nitrogen dioxide", "NOx", "particulate", "PM10", "PM2.5", "stack height", "dispersion model", "odour"],
    "designated sites": ["SSSI", "site of special scientific interest", "SAC", "special area of conservation", "SPA", "special protection area", "Ramsar", "ancient woodland", "local nature reserve", "national nature reserve", "green belt", "AONB", "national landscape", "conservation area", "scheduled monument"],
    "ecology": ["ecological impact", "biodiversity net gain", "protected species", "great crested newt", "bat survey", "habitat regulations", "HRA", "ecological appraisal", "veteran tree"],
    "flood and drainage": ["flood risk", "flood zone", "SuDS", "sustainable drainage", "surface water flooding", "attenuation", "watercourse"],
    "land quality": ["contamination", "contaminated land", "remediation", "ground gas", "landfill gas", "geo-environmental"],
    "noise": ["noise assessment", "noise impact", "acoustic", "plant noise"],
    "heat": ["heat recovery", "waste heat", "heat network", "district heating"],
}

# Power terms.
POWER_TERMS = ["generator", "generation", "gas engine", "gas turbine", "chp", "combined heat and power", "energy centre", "diesel", "fuel storage", "fuel tank", "substation", "grid connection", "private wire", "bess", "battery", "megawatt", "mw", "mva", "kva", "backup power", "standby", "resilience", "uninterruptible", "ups", "load", "power demand", "emergency power", "peak demand", "connection agreement"]

# Families of labels, most specific first.
FAMILIES = [
    ("party_applicant", r"applicant|developer|client|landowner|freeholder|operator_name|end_user|occupier"),
    ("party_adviser", r"consultant|agent|architect|engineer_practice|solicitor|planning_consult|adviser|advisor|author|prepared_by|technical_author"),
    ("party_authority", r"consultee|case_officer|local_planning_authority|planning_authority|local_authority|council_officer|statutory_(consultee|body)|authority_name|lpa\b|environment_agency|natural_england|highways_england|national_grid_(company|operator)"),
    ("party_other", r"part(y|ies)|contractor|stakeholder|third_party|organisation|company_name|supplier"),
    ("power_generation", r"generat|generator|chp\b|combined_heat|engine|turbine|peaking|peaker|prime_power|standby_power|backup_power|emergency_power|bess|battery_storage|energy_storage|fuel|diesel|gas_(supply|storage|main|connection)|hvo\b|tank|resilience|ups\b|uninterruptible|n\+1|redundan"),
    ("power_grid", r"grid|substation|electrical_infrastructure|dno\b|connection_(agreement|capacity|offer)|point_of_connection|transformer|switchgear|hv_|kv\b|mva\b|private_wire|electricity_(supply|infrastructure|network)|power_infrastructure|power_(supply|connection|route)|cable|pylon|overhead_line"),
    ("power_demand", r"it_load|power_demand|load_capacity|energy_demand|electricity_demand|mw_capacity|rack_(density|load)|design_capacity|installed_capacity|power_capacity|energy_consumption|power_usage|pue\b|megawatt|\bmw\b"),
    ("energy_efficiency_heat", r"heat_(network|recovery|reuse|export|pump)|district_heat|waste_heat|energy_efficiency|renewable|solar|photovoltaic|pv_|net_zero|carbon_(reduction|offset|neutral|footprint)|energy_statement|sustainab|breeam|epc_|greening_factor|green_roof"),
    ("cooling", r"cooling|chiller|refrigerant|air_handling|crac\b|crah\b|adiabatic|evaporative|free_cooling|heat_rejection"),
    ("water", r"water|potable|abstraction|effluent|wastewater|foul_|sewer|discharge_consent|dcww|thames_water"),
    ("flood_drainage", r"flood|drainage|suds\b|surface_water|groundwater_level|attenuation|watercourse|culvert|runoff|run_off|climate_change_allowance|sequential_test"),
    ("designated_sites", r"designat|sssi|sac\b|spa\b|ramsar|ancient_woodland|conservation_area|listed_building|scheduled_monument|green_belt|aonb|national_park|heritage|archaeolog"),
    ("ecology_biodiversity", r"ecolog|biodiversity|bng\b|habitat|species|newt|bat_|bird|badger|invasive|tree_|arboricultur|hedgerow|landscap|green_infrastructure"),
    ("air_quality_emissions", r"air_quality|emission|nox|no2|particulate|pm10|pm2|dispersion|stack_|abatement|scr\b|selective_catalytic|aqma|combustion_products"),
    ("noise", r"noise|acoustic|decibel|db\(a\)|sound_|vibration"),
    ("land_quality", r"contamina|remediation|ground_(conditions|gas|investigation)|geotechnical|geolog|hydrogeolog|aquifer|source_protection|soil|made_ground|asbestos|landfill|mining_legacy|pollution|spill"),
    ("waste", r"waste|recycl|circular_economy|spoil|excavat"),
    ("transport_access", r"transport|traffic|highway|parking|access|vehicle|hgv|trip_generation|travel_plan|cycle|pedestrian|ev_charging|delivery|servicing|road_"),
    ("socioeconomic", r"employment|staffing|jobs|economic|skills|training|community|social_value|apprentice"),
    ("permits_regulatory", r"permit|licence|license|regulat|compliance|sensitive_receptor|statutory_requirement"),
    ("construction_operation", r"construction|phasing|programme|timeline|duration|operational_hours|hours_of_(use|operation)|decommission|demolition|cemp\b|security|fencing|lighting"),
    ("eia_process", r"eia\b|environmental_impact|screening|scoping|environmental_statement|significant_effect|cumulative"),
    ("development_scale", r"floor_?(space|area)|gia\b|gea\b|height|storey|footprint|site_area|hectare|development_(scale|size)|use_class|massing|density|number_of_buildings|building_(area|scale|dimension|size|footprint)|volume|capacity_sqm|sqm|square_"),
    ("application_admin", r"application_(reference|type|number|date|status)|planning_(reference|application|history|condition|status|policy|permission|obligation)|policy_reference|document_(type|title|date|reference)|supporting_document|decision|determination|committee|validation_date|condition|s106|section_106|obligation|appeal|reference_number|revision|consultation_(period|response_date)"),
    ("site_identity", r"site_|project_|development_|proposal|proposed_|existing_|facility_|building_|location|address|postcode|grid_reference|coordinates|ward\b|layout|scheme_"),
]
UNCLASSIFIED = "unclassified"

# Kinds of documents, in order of precedence.
KIND_TIERS = [
    ("A", "statutory instrument", r"\bs\.?10[68]\b|\bsection 10[68]\b|\bsection 73\b|unilateral undertaking|planning obligation"),
    ("skip", "graphical document", r"drawing|elevation|section\b|floor plan|site location plan|location plan|block plan|masterplan|photograph|photo\b|montage|visualisation|street scene|survey plan|topographic|boundary plan|red line"),
    ("A", "statement/report/consultee response", r"planning statement|design and access|environmental statement|es (chapter|volume)|energy|sustainab|air quality|noise|flood risk|drainage|ecolog|heritage|transport (assessment|statement)|officer report|committee report|decision notice|decision\b|screening|scoping|consult(ee|ation) response|statutory consultee|environment agency|water|utilities|infrastructure|supporting (information|statement)|application form|s106|section 106"),
    ("C", "repetitive class — sampled", r"objection|public comment|neighbour (comment|response)|petition|background paper|correspondence"),
]

# Signals that count as primary generation, storage and backup.
SIGNAL_TIERS = {
    "tier1": r"(energy centre|power station|power plant|power facility|prime power|gas turbine|gas[- ]fired|gas reciprocating engine|reciprocating engine|chp|combined heat and power|cogeneration|energy reserve|onsite generation|on[- ]site generation|microgrid|behind[- ]the[- ]meter|bridge[- ]to[- ]grid|biomass|hydrogen|fuel cell|anaerobic digestion|energy from waste|district heating centre|district heating unit)",
    "storage": r"(bess|battery energy storage|battery storage|energy storage)",
    "backup": r"(generator|generators|back[- ]?up|stand[- ]?by|flue)",
}

# What kind of facility a description shows; `unless` takes a match back.
CHARACTERS = [
    ("standalone_datacentre", r"(erection|construction|development|delivery) of .{0,40}(data cent|data stor|datacent)|\d+\s*(no\.?|x)\s*data cent|data cent(re|er) (campus|buildings?|park|facility|development)|hyperscale|colocation|co-location|technical services centre", None),
    ("ancillary_server_room", r"server room|comms? room|communications room|server cabinet|rack room|ancillary (data|server|it)|serving the (existing )?(building|site|office|hospital|school|university|premises)", None),
    ("institutional_facility", r"universit|college|school|hospital|nhs\b|academy|campus building|civic|town hall|library|research (institute|facility|centre)|laborator", r"\b(hyperscale|colocation|co-location)\b"),
    ("telecoms_facility", r"telephone exchange|telecoms? exchange|bt exchange|telecommunications (centre|facility|installation)|mobile (mast|base station)|radio (mast|station)", None),
    ("standalone_datacentre", r"data cent|data stor|datacent|server hall|technical services centre|colocation|co-location|hyperscale|digital infrastructure", None),
    ("enabling_infrastructure", r"\b(substation|switchgear|transformer|grid connection|cable route|electricity infrastructure)\b", r"\b(data cent|data stor|server hall|technical services)\b"),
]
SIGNIFICANCE = {"standalone_datacentre": 5, "telecoms_facility": 4, "institutional_facility": 3, "enabling_infrastructure": 2, "ancillary_server_room": 1, "unclear": 0}

# Statements about environmental impact assessment, and which outranks which.
EIA_RULES = {
    "eia_required": r"accompanied by an environmental statement|determined to be eia development|is eia development|environmental statement (has been |is )?(submitted|provided|prepared)|eia (is )?required|environmental impact assessment (is )?required",
    "eia_not_required": r"eia (is )?not required|environmental statement not required|not (an )?eia development|screening opinion.{0,30}not required|no (eia|environmental impact assessment) (is )?required|not schedule 1|does not constitute eia development",
    "scoping": r"scoping opinion|scoped (in|out) of eia|scoping report",
    "screening_requested": r"screening opinion (request|requested|sought)|request for (an )?eia screening|regulation 6",
}

# Fuels, combined heat and power, and ways of cooling.
FUELS = {
    "HVO": r"\bhvo\b|hydrotreated vegetable oil|renewable diesel",
    "Gas": r"\bgas[- ]fired\b|natural gas|\bcng\b|\blng\b|gas (engine|turbine|reciprocating)|reciprocating engine",
    "Diesel": r"\bdiesel\b|\bgas ?oil\b|red diesel",
    "Hydrogen / fuel cell": r"hydrogen|fuel cell",
    "Biomass / biogas": r"biomass|biogas|anaerobic digest",
}
CHP = r"\bchp\b|combined heat and power|heat (offtake|network)"
COOLING = {
    "Water-cooled / chilled water": r"water[- ]cooled|chilled water|chiller",
    "Air-cooled": r"air[- ]cooled|air cooling|dry cooler",
    "Adiabatic / evaporative": r"adiabatic|evaporative|cooling tower",
    "Free cooling": r"free[- ]cooling|free air",
    "Heat reuse / offtake": r"heat (re-?use|recovery|offtake|network)|district heat",
    "Closed loop": r"closed[- ]loop|sealed system",
    "Immersion / liquid": r"immersion cool|liquid cool|direct[- ]to[- ]chip",
}

# What stands around a power figure; the last two need a reader.
POWER_CONTEXTS = [
    ("ev_charging", r"charg(er|ing|e point)|electric vehicle|\bEV\b", False),
    ("intensity_target", r"/\s*m2|/\s*m²|per square|kwh/m", False),
    ("building_services", r"heat pump|boiler|ashp|hvac|air condition|lift\b|lighting", False),
    ("onsite_renewables", r"\bpv\b|solar|photovolta|kwp", False),
    ("standby_generation", r"generat|genset|standby|back[- ]?up|diesel", True),
    ("grid_connection", r"grid|substation|connection|supply capacity|import", True),
]

# Routes by which a record was found, by the beginning of its tag.
ROUTES = [
    ("barbour:", "Barbour ABI"), ("nsip_energy", "Planning Inspectorate"), ("nsip_register", "Planning Inspectorate"), ("dc_keyword", "Keyword search"),
    ("energy_national:", "Energy search near a site"), ("spatial:", "Next to a known site"), ("operator:", "Operator watch-list"), ("cohort:", "Curated cohort"),
    ("parent_backfill:", "Parent application"), ("foxglove", "Foxglove list"), ("duplicate_of:", "Duplicate record"), ("exclude:", "Reviewed and excluded"),
]


def bounded(term: str) -> str:
    """A pattern for a term between characters that are no letters or digits, hyphens and blanks alike."""
    body = r"[-\s]*".join(re.escape(p) for p in re.split(r"[-\s]+", term) if p)
    return rf"(?i)(?<![A-Za-z0-9]){body}(?![A-Za-z0-9])"


def term_hits(text: Column, terms: list[str]) -> Column:
    """The terms that stand in the text, in the order given. A pattern is tried only where its first word is in the text at all."""
    low = F.lower(text)
    first = [next(p for p in re.split(r"[-\s]+", t) if p).lower() for t in terms]
    return F.array_compact(F.array(*[F.when(F.contains(low, F.lit(w)) & text.rlike(bounded(t)), F.lit(t)) for w, t in zip(first, terms, strict=True)]))


def subject_signals(text: Column, subjects: dict[str, list[str]] = SUBJECTS) -> Column:
    """array<struct(subject, terms)> of the subjects with a term in the text."""
    found = F.array(*[F.struct(F.lit(s).alias("subject"), term_hits(text, terms).alias("terms")) for s, terms in subjects.items()])
    return F.filter(found, lambda s: F.size(s["terms"]) > 0)


def first_rule(text: Column, rules: list[tuple[str, str]], otherwise: str) -> Column:
    """The name of the first rule whose pattern is in the text."""
    out = F.when(text.isNull(), otherwise)
    for name, pattern in rules:
        out = out.when(text.rlike("(?i)" + pattern), name)
    return out.otherwise(otherwise)


def family_for(label: Column) -> Column:
    return first_rule(F.lower(F.trim(label)), FAMILIES, UNCLASSIFIED)


def checked_family(value: Column, label: Column) -> Column:
    """The family given, if it is one, else that of the label."""
    return F.when(value.isin([n for n, _ in FAMILIES] + [UNCLASSIFIED]), value).otherwise(family_for(label))


def kind_tier(kind: Column) -> Column:
    """struct(tier, reason) of a document's kind."""
    out = F.when(kind.isNull(), F.struct(F.lit("B").alias("tier"), F.lit("unclassified prose").alias("reason")))
    for tier, reason, pattern in KIND_TIERS:
        out = out.when(kind.rlike("(?i)" + pattern), F.struct(F.lit(tier).alias("tier"), F.lit(reason).alias("reason")))
    return out.otherwise(F.struct(F.lit("B").alias("tier"), F.lit("unclassified prose").alias("reason")))


def page_score(text: Column, power_terms: list[str] = POWER_TERMS, subjects: dict[str, list[str]] = SUBJECTS) -> Column:
    """Distinct power terms and subject terms of a page."""
    power = "|".join(rf"(?<![A-Za-z0-9]){re.escape(t)}(?![A-Za-z0-9])" for t in power_terms)
    hits = F.size(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(f"(?i)({power})"), F.lit(1)), F.lower)))
    terms = F.aggregate(subject_signals(text, subjects), F.lit(0), lambda n, s: n + F.size(s["terms"]))
    return F.coalesce(hits + terms, F.lit(0))


def tier_hits(signals: Column, pattern: str) -> Column:
    """How many of the signals the pattern is in."""
    return F.size(F.filter(F.coalesce(signals, F.array().cast("array<string>")), lambda s: F.lower(s).rlike(pattern)))


def character_for(text: Column) -> Column:
    t = F.lower(text)
    out = F.when(text.isNull() | (text == ""), "unclear")
    for name, pattern, unless in CHARACTERS:
        fits = t.rlike(pattern)
        out = out.when(fits & ~t.rlike(unless) if unless else fits, name)
    return out.otherwise("unclear")


def ranked_label(ranked: Column, floor: float, noun: str = "mentions") -> Column:
    """`Top (9 mentions), Next (4); also referenced: Rare` of array<struct(label, n)>, most first."""
    top = F.try_element_at(ranked, F.lit(1))
    rest = F.slice(ranked, 2, F.greatest(F.size(ranked) - 1, F.lit(0)))
    major = F.transform(F.filter(rest, lambda r: r["n"] >= top["n"] * floor), lambda r: F.concat(r["label"], F.lit(" ("), r["n"].cast("string"), F.lit(")")))
    minor = F.array_join(F.transform(F.filter(rest, lambda r: r["n"] < top["n"] * floor), lambda r: r["label"]), ", ")
    head = F.concat(top["label"], F.lit(" ("), top["n"].cast("string"), F.lit(f" {noun})"))
    line = F.array_join(F.concat(F.array(head), major), ", ")
    return F.when(F.size(ranked) < 1, "").otherwise(F.concat(line, F.when(minor != "", F.concat(F.lit("; also referenced: "), minor)).otherwise("")))


def power_context(context: Column) -> Column:
    """struct(context, flagged) of what stands around a power figure."""
    out = None
    for name, pattern, flagged in POWER_CONTEXTS:
        row = F.struct(F.lit(name).alias("context"), F.lit(flagged).alias("flagged"))
        test = context.rlike("(?i)" + pattern)
        out = F.when(test, row) if out is None else out.when(test, row)
    return out.otherwise(F.struct(F.lit("unclassified").alias("context"), F.lit(True).alias("flagged")))


def routes(tags: Column) -> Column:
    """The distinct routes of a record's tags, in order."""

    def route(tag: Column) -> Column:
        out = None
        for prefix, label in ROUTES:
            test = F.startswith(tag, F.lit(prefix))
            out = F.when(test, label) if out is None else out.when(test, label)
        return out

    return F.array_distinct(F.array_compact(F.transform(F.coalesce(tags, F.array().cast("array<string>")), route)))

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernstone.functions import geo, lexicon, numbers, text


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


@pytest.mark.parametrize(
    ("fn", "value", "want"),
    [
        (text.norm_ws, "  A\n\tB  c ", "a b c"),
        (text.norm_quote, "“The  data centre s will” – use • 5 MW.", "the data centres will-use 5 mw."),
        (text.digit_blob, "1,234.5 MW", "12345"),
        (lambda c: text.trim_words(c, 12), "one two three four", "one two…"),
        (lambda c: text.trim_words(c, 99), " short ", "short"),
        (text.anchor_slug, "PTNO-12 / A b!", "ptno-12-a-b"),
        (text.clean_filename, 'a/b:c*"d" .', "a b c d"),
        (text.md_cell, "a|b\nc", "a\\|b c"),
        (text.formula_guard, "=SUM(A1)", "'=SUM(A1)"),
        (text.formula_guard, "plain", "plain"),
        (text.tidy_case, "ERECTION OF A HALL (PHASE 1", "Erection of a hall (phase 1)"),
        (text.tidy_case, "erection of A", "Erection of A"),
        (text.coerce_page, "[PAGE 7]", 7),
        (text.nul_strip, "a\x00b", "ab"),
        (text.council_words, "TowerHamlets", "tower hamlets"),
        (text.council_words, "Charnwood Borough Council (Phone: 1)", "charnwood"),
        (text.url_host, "https://A.example.com:8080/x?y", "a.example.com"),
        (text.strip_html, "<p>a<script>x</script>&amp;<b>b</b></p>", "a & b"),
        (text.quote_key, "The, Quick: brown " * 9, "the quick brown the quick brown the quick brown the quick brown"),
        (text.authority_key, "London Borough of Tower Hamlets", "towerhamlets"),
        (text.authority_key, "Bucks", "buckinghamshire"),
        (numbers.clean_id, "12871423.0", "12871423"),
        (numbers.clean_text, " . ", None),
        (numbers.clean_number, "0.0", None),
        (numbers.count_word, "four", 4),
    ],
)
def test_values(spark, fn, value, want):
    assert one(spark, fn(F.lit(value))) == want


def test_nul_in_dates(spark):
    assert one(spark, text.parse_date(F.lit("2024-02-30x"))) is None
    assert str(one(spark, text.parse_date(F.lit("2024-02-28T10:00")))) == "2024-02-28"


def test_fragments(spark):
    assert one(spark, text.quote_fragments(F.lit("“one two… three.”"))) == ["one two", "three"]
    parts = lambda *p: F.array(*map(F.lit, p))
    assert one(spark, text.fragments_in_order(F.lit("a b c"), parts("a", "c")))
    assert not one(spark, text.fragments_in_order(F.lit("a b c"), parts("c", "a")))
    assert not one(spark, text.fragments_in_order(F.lit("ab"), parts("ab", "b")))


def test_candidate_refs(spark):
    said = "EPF/1165/22(Outline EPF/1136/19) A1/A3/B8 P21/S0274/FUL EPF/1165/22"
    assert one(spark, text.candidate_refs(F.lit(said))) == ["EPF/1165/22", "EPF/1136/19", "P21/S0274/FUL"]


def test_authorities(spark):
    same = lambda a, b: one(spark, text.same_authority(F.lit(a), F.lit(b)))
    assert same("Newport City Council (Phone: 1)", "Newport") and not same("Hart District Council", "Hartlepool") and same(None, "x")


@pytest.mark.parametrize(("mw", "want"), [(2.25, 2.2), (12.5, 10.0), (17.5, 20.0), (105.0, 100.0), (115.0, 120.0)])
def test_rounding_halves_to_even(spark, mw, want):
    assert one(spark, numbers.round_sensibly(F.lit(mw))) == want


@pytest.mark.parametrize(("x", "want"), [(12.5, 12.5), (123456.0, 123500.0), (0.0123456, 0.01235), (0.0, 0.0)])
def test_sig4(spark, x, want):
    assert math.isclose(one(spark, numbers.sig4(F.lit(x))), want)


def test_units(spark):
    mw = lambda v, u: one(spark, numbers.to_mw(F.lit(v), F.lit(u)))
    assert mw(5.0, "GW") == 5000 and mw(5.0, "mva") is None and mw(5.0, "MWh") is None
    assert one(spark, numbers.band(F.lit(20.0), numbers.MW_BANDS)) == "medium_20_100mw"
    assert one(spark, numbers.number_before(F.lit("heat 800mw and 1,300.5 MWe"), "MWe")) == 1300.5


def test_jaccard_of_nothing(spark):
    a = lambda *p: F.array(*map(F.lit, p)).cast("array<string>")
    assert one(spark, text.jaccard(a(), a())) == 1 and one(spark, text.jaccard(a("x"), a())) == 0


def test_grid_reference_control_point():
    lat, lon = geo.grid_to_degrees(np.array([651409.903]), np.array([313177.270]))
    assert abs(lat[0] - 52.657977) < 5e-5 and abs(lon[0] - 1.716038) < 5e-5


def test_haversine(spark):
    km = one(spark, geo.haversine_km(F.lit(51.5), F.lit(-0.12), F.lit(48.86), F.lit(2.35)))
    assert 340 < km < 345


@pytest.mark.parametrize(
    ("kind", "tier"),
    [("Section 106 Agreement", "A"), ("Section 1 - Drawing", "skip"), ("Planning Statement", "A"), ("Letter of objection", "C"), ("Email", "B"), (None, "B")],
)
def test_kind_tiers(spark, kind, tier):
    assert one(spark, lexicon.kind_tier(F.lit(kind).cast("string")))["tier"] == tier


@pytest.mark.parametrize(("label", "family"), [("cooling_water_use", "cooling"), ("generator_testing_hours", "power_generation"), ("case_officer", "party_authority"), ("mitigation", "unclassified"), (None, "unclassified")])
def test_families(spark, label, family):
    assert one(spark, lexicon.family_for(F.lit(label).cast("string"))) == family


def test_signals(spark):
    found = one(spark, lexicon.subject_signals(F.lit("A Cooling-Water intake; sacrificial SAC; NOX")))
    assert {r["subject"]: r["terms"] for r in found} == {"water": ["cooling water"], "air": ["NOx"], "designated sites": ["SAC"]}


def test_page_score(spark):
    assert one(spark, lexicon.page_score(F.lit("A 1.5 MW generator, another generator, SSSI"))) == 3
    assert one(spark, lexicon.page_score(F.lit(None).cast("string"))) == 0


@pytest.mark.parametrize(
    ("said", "want"),
    [("Erection of a data centre with server rooms", "standalone_datacentre"), ("AC units for the server room", "ancillary_server_room"), ("University laboratory with data hall", "institutional_facility"), ("New substation", "enabling_infrastructure"), ("A shed", "unclear")],
)
def test_characters(spark, said, want):
    assert one(spark, lexicon.character_for(F.lit(said))) == want


def test_routes_and_labels(spark):
    tags = F.array(F.lit("barbour:1"), F.lit("spatial:x"), F.lit("barbour:2"), F.lit("zzz"))
    assert one(spark, lexicon.routes(tags)) == ["Barbour ABI", "Next to a known site"]
    ranked = F.array(*[F.struct(F.lit(a).alias("label"), F.lit(n).alias("n")) for a, n in (("Diesel", 100), ("HVO", 20), ("Gas", 3))])
    assert one(spark, lexicon.ranked_label(ranked, 0.15)) == "Diesel (100 mentions), HVO (20); also referenced: Gas"


def test_portals(spark):
    fam = lambda u: one(spark, text.portal_family(F.lit(u).cast("string")))
    assert fam(None) == "no_url" and fam("https://x/online-applications/a") == "idox" and fam("https://planningregister.planningsystemni.gov.uk/1") == "ni_planning" and fam("https://x/") == "bespoke/other"

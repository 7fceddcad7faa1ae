import pytest
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom.functions import text as X


@pytest.mark.parametrize(
    ("sku", "new"),
    [
        ("OLD-ABC-1234", "NEW-1234-ABC"),
        ("old-abc-1234", K.SKU_ERROR),
        ("OLD-ABC-123", K.SKU_ERROR),
        ("OLD-ABC-1234x", K.SKU_ERROR),
        ("OLD-ABC-1234\n", "NEW-1234-ABC"),
        ("", K.SKU_ERROR),
        (None, None),
    ],
)
def test_translate_sku(one, sku, new):
    assert one(X.translate_sku("a"), row=(sku,)) == new


def test_parse_keywords_trims_and_drops_blanks(one):
    assert one(X.parse_keywords("a"), row=(" delta, live ,,\ttable\n, ",)) == ["delta", "live", "table"]


def test_words_keep_letters_of_any_script(one):
    assert one(X.words("a"), row=("Où est-ce? 42 Ärger",)) == ["où", "est", "ce", "42", "ärger"]


@pytest.mark.parametrize(
    ("notes", "facts"),
    [
        (f"{K.NOTES_HEADER}\n- one\n- two", ["one", "two"]),
        (f"- {K.NOTES_PREFIX}\n- one", ["one"]),
        (f"\t {K.NOTES_PREFIX} and more", []),
        ("plain\n\n -- dashed \n hard space ", ["plain", "dashed", "hard space"]),
        (K.NOTES_HEADER, []),
        ("", []),
    ],
)
def test_parse_notes(one, notes, facts):
    assert one(X.parse_notes("a"), row=(notes,)) == facts


def test_notes_round_trip(one):
    facts = ["first fact", "second - with a dash", "third"]
    noted = X.render_notes(F.col("facts"))
    assert one(X.parse_notes(noted), "facts array<string>", (facts,)) == facts
    assert one(noted, "facts array<string>", ([],)) is None


def test_strip_matches_python(one):
    for sample in ["  x ", "　x ", "\x1cx\x1f", "\x85x\x0b", "x y", "", "​x"]:
        assert one(X.strip("a"), row=(sample,)) == sample.strip()


def test_first_filled_skips_empty_text(one):
    columns = [F.lit(None).cast("string"), F.lit(""), F.col("a"), F.lit("z")]
    assert one(X.first_filled(*columns), row=("x",)) == "x"
    assert one(X.first_filled(*columns), row=("",)) == "z"


@pytest.mark.parametrize(
    ("named", "kind"),
    [
        ("Human and Synthetic", K.HUMAN_SOURCE),
        ("SYNTHETIC_FROM_DOC", K.SYNTHETIC_SOURCE),
        ("", None),
        (None, None),
        ("crawl", None),
    ],
)
def test_source_type(one, named, kind):
    assert one(X.source_type("a"), row=(named,)) == kind


def test_identifiers(one):
    assert one(X.principal_slug("a"), row=("jo.van.doe@example.com",)) == "jo_van_doe"
    assert one(X.quote_ident("a"), row=("cat.sch.table",)) == "`cat`.`sch`.`table`"
    assert one(X.tool_name("a"), row=("cat.sch.fn",)) == "cat__sch__fn"
    assert one(X.folder_name("a"), row=("cat.sch.volume",)) == "cat/sch/volume"


def test_percent(one):
    assert one(X.pct("r"), "r double", (0.3,)) == "30%"
    assert one(X.pct("r"), "r double", (0.004,)) == "0%"


@pytest.mark.parametrize(
    ("keywords", "score"), [(["spark"], 1), (["SPARK", "spark"], 2), (["park"], 1), ([""], 1), (["x"], 0), ([], 0)]
)
def test_keyword_score(one, keywords, score):
    assert one(X.keyword_score("a", keywords), row=("Apache Spark",)) == score


def test_place_prompt(one):
    schema = "m array<struct<role:string,content:string>>"
    chat = [("system", "s"), ("user", "q")]

    def placed(messages, place):
        rows = one(X.place_prompt("m", F.lit("P"), place), schema, (messages,))
        return [(r["role"], r["content"]) for r in rows]

    assert placed(chat, "user") == [("system", "s"), ("user", "P")]
    assert placed(chat, "system") == [("system", "P"), ("user", "q")]
    assert placed(chat[1:], "system") == [("system", "P"), ("user", "q")]
    assert placed([], "system") == [("system", "P")]
    with pytest.raises(ValueError):
        X.place_prompt("m", F.lit("P"), "assistant")


def test_fill_template(one):
    filled = X.fill_template("{{kept}} <{a}> {a}", a="a")
    assert one(filled, row=("x{y}",)) == "{kept} <x{y}> x{y}"
    assert one(filled, row=(None,)) is None
    with pytest.raises(ValueError, match="question"):
        X.fill_template("{question}", a="a")

"""Scalar expressions: input and expected output."""

import pytest
from pyspark.sql import functions as F

from sedgeline.functions import dates, hashes, numbers, text, urls


def of(spark, expression, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "expression, pairs",
    [
        (text.header_key, {"  Date_Rec'd :": "date rec'd", "Our\nReference.": "our reference", "": "", None: None}),
        (text.body_name_key, {"Foo Board (Holdings) Ltd.": "foo board", "Údarás na X DAC": "údarás na x", "Limited Access": "limited access"}),
        (text.match_key, {"The Bród & Co (x)": "brod and co", "A/B": "a b", None: None}),
        (text.local_authority_name, {"County Council - Leitrim": "Leitrim County Council", "City & County Council - Cork": "Cork City and County Council", "Leitrim": None}),
        (text.name_slug, {"Dún & Co.": "dun-and-co", "--": ""}),
        (text.text_slug, {"Dún Laoghaire, X": "dún-laoghaire-x", "": "unknown", None: "unknown"}),
        (text.alias_key, {'Table A: "Cork  City".': "cork city", " X : ": "x"}),
        (text.bare_value, {" Granted.; ": "granted", "Straße": "strasse"}),
        (dates.date_cell, {"2024-02-30": None, "24.10.23": "2023-10-24", "1/13/2020": "2020-01-13", "14th July 2016": "2016-07-14", "12-jan-75": "1975-01-12", "23.02.'18": "2018-02-23", "Ext to 13/06/2018": "2018-06-13", "July 4, 2019": "2019-07-04", "*02/01/2018 9557": "2018-01-02", "x" * 61 + "1": None, "": None, None: None, "pending": None, "6^{th} June 2023": "2023-06-06"}),
        (lambda c: dates.deadline(c)["precision"], {"Q4 2024": "quarter", "2022 Q4": "quarter", "2029": "year", "Q1 2024 - Q3 2025": "range", "Annual campaigns": "annual", "Annual 2022": None, "As soon as practicable": None, "01/02/2024": None, "May 2024": "month", "31 April 2024": None, None: None}),
        (lambda c: dates.deadline(c)["end"].cast("string"), {"Q1 2024 - Q3 2025": "2025-09-30", "Feb 2024": "2024-02-29", "2020–2022": "2022-12-31"}),
        (dates.date_cell_or_guess, {"Wed 3 Jan 2024": "2024-01-03", "2024/05/06": "2024-06-05", "nothing": None}),
        (lambda c: numbers.amount(c)["value"], {"€7,000,000": 7000000, "€ 1 234": 1234, "115,974.00": 115974, "1,23": None, "12.50": None, "€": None, "ten": None, None: None}),
        (lambda c: numbers.amount(c)["error"], {"": "empty", "ten": "letters", "€ -": "no_digits", "12.5": "not_numeric", "12.50": "sub_euro_amount", "1,2345": "ambiguous_grouping", ",123": "ambiguous_grouping", "1a": "letters"}),
        (lambda c: numbers.activity_code(c)["group"], {"A0112": "011", "x": None}),
        (urls.registrable_domain, {"https://www.foo.co.uk/x": "foo.co.uk", "http://a.b.gov.ie": "gov.ie", "nohost": "", None: "", "http://localhost/": ""}),
        (urls.site_key, {"https://www.gov.ie/en/org/dept/page": "gov.ie/en/org/dept", "https://x.ie/a": "x.ie"}),
        (urls.is_safe_url, {"https://x.ie/a": True, "http://10.0.0.1/": False, "ftp://x.ie": False, "https://u@x.ie": False, "http://localhost/": False, None: False}),
        (urls.guessed_domains, {"Health and Safety Authority": ["hsa.ie", "hsa.com", "healthsafetyauthority.ie", "healthsafetyauthority.com", "health-safety-authority.ie", "health-safety-authority.com"]}),
        (text.emails, {"A@b.ie, foi@b.ie a@B.ie": ["a@b.ie", "foi@b.ie"], "": [], None: None}),
        (lambda c: text.joined_lines(F.split(c, "\n")), {"inter-\nnal\nPart- \nTwo": "internal Part- Two", "": ""}),
        (lambda c: text.list_kind(F.split(c, "\n")), {"- a\n* b": "bullet", "1. a\n2) b": "ordered", "a\n- b": None, "": None}),
        (text.without_markdown, {"## T\n**b** [x](u)\n---": "T\nb x\n"}),
        (lambda c: text.has_keyword(c, "IT"), {"IT costs": True, "it costs": False, "SPLIT": False}),
        (lambda c: text.reference_parts(c)["number"], {"FOI/2024/264": 264, "F17/821": 821, "FOI 429 of 2018": 429, "REQ 00196": 196, "?": None, None: None}),
    ],
)
def test_expression(spark, expression, pairs):
    assert of(spark, expression, pairs) == list(pairs.values())


def test_row_id(spark):
    df = spark.createDataFrame([("https://example.ie/foi.pdf", 5)], "u string, i int")
    assert df.select(hashes.row_id(F.col("u"), F.col("i"))).first()[0] == "397a0921ddc1"


def test_set_fingerprint_ignores_order(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (2, "a"), (3, "a")], "k int, v string")
    got = {r[0]: r[1] for r in df.groupBy("k").agg(hashes.set_fingerprint(F.col("v"))).collect()}
    assert got[1] == got[2] != got[3]

from pyspark.sql import functions as F

from hearth.functions.text import html_to_text, strip_fences
from hearth.operators import replies

GOOD = '{"title": "T", "monthly_rent_eur": 500, "neighborhood": "Centru", "rooms": 2, "is_pet_friendly": false}'


def parse(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "reply_id long, reply string")
    v = {r["reply_id"]: (r["accepted"], r["n_listings"]) for r in replies.validate_replies(df).collect()}
    k = {r["reply_id"]: r["root_kind"] for r in replies.repair_replies(df).collect()}
    lst = replies.reply_listings(df).collect()
    return v, k, lst


def test_root_shapes(spark):
    texts = ['{"listings": [%s]}' % GOOD, '```json\n{"listings": [%s]}\n```' % GOOD, "[%s]" % GOOD, GOOD,
             '{"other": 1}', '```\n{"listings": []}\n```', "no json here", "null", "5", '"plain text"',
             '"has listings"', '{"listings": null}', "  [%s, %s]  " % (GOOD, GOOD)]
    v, k, _ = parse(spark, texts)
    assert [k[i] for i in range(len(texts))] == ["listings", "listings", "array", "single", "other", "invalid",
                                                  "invalid", "invalid", "invalid", "string", "string", "listings",
                                                  "array"]
    assert [v[i] for i in range(len(texts))] == [(True, 1), (True, 1), (True, 1), (True, 1), (True, 0),
                                                  (False, 0), (False, 0), (False, 0), (False, 0), (True, 0),
                                                  (False, 0), (False, 0), (True, 2)]


def test_lax_coercion_and_all_or_nothing(spark):
    def item(rent, pets="false", extra=""):
        return ('{"title": "T", "monthly_rent_eur": %s, "neighborhood": "N", "rooms": "3", '
                '"is_pet_friendly": %s%s}' % (rent, pets, extra))
    texts = ['[%s]' % item('"500"'), '[%s]' % item("500.0", '"yes"'), '[%s]' % item("500.5"),
             '[%s, %s]' % (item("400"), item("null")), '[{"title": "T"}]', '[%s]' % item("7", "1")]
    v, _, lst = parse(spark, texts)
    assert [v[i][0] for i in range(len(texts))] == [True, True, False, False, False, True]
    got = sorted((r["reply_id"], r["monthly_rent_eur"], r["rooms"], r["is_pet_friendly"]) for r in lst)
    assert got == [(0, 500, 3, False), (1, 500, 3, True), (5, 7, 3, True)]


def test_row_level_option_keeps_valid_listings(spark):
    df = spark.createDataFrame([(0, "[%s, %s]" % (GOOD, '{"title": 1}'))], "reply_id long, reply string")
    assert replies.reply_listings(df).count() == 0
    assert replies.reply_listings(df, all_or_nothing=False).count() == 1


def test_strip_fences(spark):
    df = spark.createDataFrame([("```json{}```",), ("```{}```",), ("{}",)], "t string")
    assert [r[0] for r in df.select(strip_fences(F.col("t"))).collect()] == ["{}", "```{}", "{}"]


def test_html_to_text(spark):
    html = ("<html><head><title>x</title></head><body><header>H</header><nav><a>menu</a></nav>"
            "<noscript>ns</noscript><svg><path/></svg><img src='a.png'><script>var a='</p>';</script>"
            "<style>p{}</style><!-- c --><h1>Title &amp; more</h1><p>One<br>Two</p>  <div>Three&nbsp;x</div>"
            "<footer>F</footer></body></html>")
    missing_end = "<body><p>Only &quot;this&quot;</p>"
    df = spark.createDataFrame([(html,), (missing_end,)], "html string")
    got = [r[0] for r in df.select(html_to_text(F.col("html"))).collect()]
    assert got == ["Title & more\nOne\nTwo\nThree\u00a0x", 'Only "this"']

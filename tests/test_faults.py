"""Ordinary nulls, NaN, empty tables and failing paths."""

import pytest

from hearth.functions.numeric import deal_label
from hearth.functions.text import text_segments
from hearth.operators import alerts, cleaning, deals, profiling
from hearth.streaming import listings as S


def test_seed_casts_take_any_text(spark):
    df = spark.createDataFrame([("NaN", "1e300"), ("Infinity", "x"), ("12.9", "-3.9"), (None, "")],
                               "monthly_rent_eur string, rooms string")
    got = [(r[0], r[1]) for r in cleaning.seed_casts(df).collect()]
    assert got == [(None, None), (None, None), (12, -3), (None, None)]


def test_alert_message_with_missing_parts(spark):
    df = spark.createDataFrame([(1, None, 300.0, "Complexul", None)],
                               "id long, title string, monthly_rent_eur double, neighborhood string, rooms int")
    assert alerts.alert_rows(df).first()["message"].splitlines() == [
        "🚨 **New Apartment Alert!** 🚨", "**Title:** N/A", "**Price:** 300.0 EUR", "**Location:** Complexul", "**Rooms:** N/A"]


def test_deal_label_needs_both_prices(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (1.0, 1.0)], "a double, p double")
    assert [r[0] for r in df.select(deal_label(F.col("a"), F.col("p"))).collect()] == [None, None, "Fair Price"]
    q = deals.deal_quality(spark.createDataFrame([("Great Deal", None), ("Great Deal", "Great Deal")], "deal string, true_deal string"))
    assert tuple(q.first()[c] for c in ("n", "unlabelled", "tp", "accuracy")) == (1, 1, 1, 1.0)


def test_rates_over_nothing(spark):
    q = deals.deal_quality(spark.createDataFrame([], "deal string, true_deal string")).first()
    assert q["n"] == 0 and q["accuracy"] is None
    df = spark.createDataFrame([], "title string, neighborhood string, monthly_rent_eur double, rooms int")
    r = profiling.quality_rates(df).first()
    assert (r["rows"], r["completeness_percent"], r["uniqueness_percent"], r["validity_percent"]) == (0, 0.0, None, None)


def test_segments_lose_nothing(spark):
    texts = ["", "a", "x" * 10_000, "y" * 10_001, "é" * 25_000]
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(text_segments(F.col("t")).alias("s"))
    got = [r["s"] for r in df.collect()]
    assert ["".join(s) for s in got] == texts and [len(s) for s in got] == [1, 1, 1, 2, 3]
    assert max(len(x) for s in got for x in s) == 10_000


def test_an_unreadable_log_is_not_an_empty_table(spark, tmp_path):
    assert S.latest_paths(spark, f"file://{tmp_path}/none") == {}
    with pytest.raises(Exception, match="(?i)scheme|filesystem|file system"):
        S.latest_paths(spark, "nosuchfs://host/root")
    with pytest.raises(Exception, match="(?i)scheme|filesystem|file system"):
        S.is_committed(spark, "nosuchfs://host/root", 0)


def test_lax_coercion_of_numbers(spark):
    from hearth.operators import replies
    rows = [(1, '[{"title": "a", "monthly_rent_eur": "500.0", "neighborhood": "n", "rooms": 2, "is_pet_friendly": 1.0}]'),
            (2, '[{"title": "a", "monthly_rent_eur": "500.5", "neighborhood": "n", "rooms": 2, "is_pet_friendly": true}]'),
            (3, '[{"title": "a", "monthly_rent_eur": 5, "neighborhood": "n", "rooms": 2, "is_pet_friendly": 0.5}]')]
    got = replies.reply_listings(spark.createDataFrame(rows, "reply_id long, reply string")).collect()
    assert [(r["reply_id"], r["monthly_rent_eur"], r["is_pet_friendly"]) for r in got] == [(1, 500, True)]


def test_every_listing_is_in_a_reply(spark):
    from pyspark.sql import functions as F

    from hearth.operators import replies
    df = spark.range(200).select("id", F.concat(F.lit("t"), "id").alias("title"), F.lit(7.0).alias("monthly_rent_eur"),
                                 F.lit("n").alias("neighborhood"), F.lit(2).alias("rooms"), F.lit(True).alias("is_pet_friendly"))
    out = replies.render_replies(df).collect()
    text = "\n".join(r["reply"] for r in out)
    assert all(text.count(f'"t{i}"') == 1 for i in range(200)) and {r["shape"] for r in out} == set(range(8))
    assert len({r["reply_id"] for r in out}) == len(out)


def test_page_text_written_by_hand(spark):
    from pyspark.sql import functions as F

    from hearth.functions.text import html_to_text
    cases = [
        ("<body><p>400 &#8364; &euro; &#x20AC; &#537;i &acirc; &amp;lt; &nosuch; &#0; &#55296; a&amp;b</p></body>",
         "400 € € € și â &lt; &nosuch; \ufffd \ufffd a&b"),
        ("<body><p>one</p><script>if (a < b) { leak() }", "one"),
        ("<body><p>one<!-- gone --> two</p><style>p{}</style><p>three</body>", "one two\nthree"),
        ("<p>&apos;q&quot; &#128512;</p>", "'q\" \U0001f600"),
        ("plain", "plain"), ("", ""),
    ]
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(cases)], "i int, h string")
    got = {r["i"]: r["t"] for r in df.select("i", html_to_text(F.col("h")).alias("t")).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]

"""Judge urls by rules and, where no rule fits, by a logistic regression.

The model reads hashed character n-grams of the host and of the path.  It is
fitted on a small table of labelled urls (a parameter) by Spark's own logistic
regression; its weights are a fixed number of doubles, which travel inside the
expression that scores.  Scoring is one expression per row: no join, no
shuffle and no Python.

Defined cases.  A NULL url or one without ``://`` has an empty host and path;
no rule fits it and the model judges the empty features by its intercept.
Empty tables give empty results; repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm.common import ascii_lower

BUCKETS = 4096
GRAMS = (3, 4, 5)

#: Labelled urls: 1 for sites to block.  Fixed values, of general words; both kinds have the same forms of paths.
LABELLED = [
    ("http://www.discount-pills.example/offer/12", 1),
    ("https://online-pharmacy.example/buy/now", 1),
    ("http://cheapest-meds.example/en/order", 1),
    ("https://pills-without-prescription.example/de/3", 1),
    ("http://cheap-viagra.example/fr/20", 1),
    ("https://www.cheap-watches.example/sale", 1),
    ("http://best-casino.example/slots/3", 1),
    ("https://blog.casino-bonus.example/en/77", 1),
    ("http://royal-casino.example/play", 1),
    ("https://live-poker.example/es/8", 1),
    ("http://www.poker-room.example/win/big", 1),
    ("https://online-bets.example/odds", 1),
    ("http://sports-betting.example/en/41", 1),
    ("https://m.bet-bonus.example/article/5", 1),
    ("http://free-spins.example/de/3", 1),
    ("https://free-money.example/loan/fast", 1),
    ("http://m.payday-loans.example/apply", 1),
    ("https://instant-loans.example/en/62", 1),
    ("http://win-prize.example/claim", 1),
    ("https://lottery-winner.example/fr/9.html", 1),
    ("http://spam-links.example/fr/10.html", 1),
    ("https://www.link-farm.example/links/9", 1),
    ("http://seo-spam.example/item/5", 1),
    ("https://bulk-spam.example/en/2", 1),
    ("http://content-farm.example/de/35", 1),
    ("https://backlinks-seo.example/story", 1),
    ("http://adult-chat.example/es/71", 1),
    ("https://www.adult-videos.example/live", 1),
    ("http://xxx-cams.example/videos", 1),
    ("https://hot-singles.example/en/334", 1),
    ("http://sex-dates.example/page/4", 1),
    ("https://ads-server.example/click?id=4", 1),
    ("http://www.popup-ads.example/pixel/1", 1),
    ("https://click-track.example/en/6", 1),
    ("http://tracking-pixel.example/t/1", 1),
    ("https://banner-ads.example/fr/12?ref=mail", 1),
    ("http://fake-diploma.example/books/7", 1),
    ("https://miracle-diet.example/today", 1),
    ("http://earn-cash.example/docs/start", 1),
    ("https://crypto-doubler.example/en/3.html", 1),
    ("http://news.city.example/en/2024/story", 0),
    ("https://www.library.example/books/7", 0),
    ("http://school.example/lessons/math", 0),
    ("https://weather.example/today", 0),
    ("http://wiki.example/page/river", 0),
    ("https://museum.example/fr/visite", 0),
    ("http://www.garden.example/de/rosen", 0),
    ("https://recipes.example/es/sopa", 0),
    ("http://blog.travel.example/en/coast", 0),
    ("https://m.health.example/en/advice", 0),
    ("http://www.history.example/en/62", 0),
    ("https://science.example/articles/9", 0),
    ("http://www.music.example/de/15", 0),
    ("https://blog.photo.example/en/3.html", 0),
    ("http://code.example/docs/start", 0),
    ("https://forum.example/topic/18", 0),
    ("http://www.nation.example/en/334", 0),
    ("https://station.example/fr/20", 0),
    ("http://mother-and-child.example/es/48?page=2", 0),
    ("https://theatre.example/de/35.html", 0),
    ("http://www.northern-times.example/en/519", 0),
    ("https://brother.example/page/4", 0),
    ("http://education.example/en/41", 0),
    ("https://translation.example/fr/12?ref=mail", 0),
    ("http://the-other-side.example/es/71/", 0),
    ("https://thought.example/item/5", 0),
    ("http://m.lighthouse.example/links/9", 0),
    ("https://www.earth.example/en/77", 0),
    ("http://farmers-market.example/de/3", 0),
    ("https://train-times.example/order", 0),
    ("http://windows-repair.example/offer/12", 0),
    ("https://winter-sports.example/es/8", 0),
    ("http://railway-track.example/en/6", 0),
    ("https://free-software.example/live", 0),
    ("http://www.chess-club.example/play", 0),
    ("https://linked-data.example/apply", 0),
    ("http://blog.university.example/en/2", 0),
    ("https://hotel-guide.example/fr/10.html", 0),
    ("http://adult-education.example/en/3", 0),
    ("https://www.village-hall.example/videos", 0),
]


def url_host(url: Column) -> Column:
    """From the first ``://`` up to the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def _buckets(part: str, text: Column, n: int) -> Column:
    """The buckets of the n-grams of one text; a text shorter than ``n`` has none."""
    last = F.char_length(text) - n + 1
    starts = F.when(last > 0, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    hashed = lambda i: F.xxhash64(F.lit(part), F.substring(text, i, F.lit(n)))
    return F.transform(starts, lambda i: F.pmod(hashed(i), F.lit(BUCKETS)).cast("int"))


def grams(host: Column, path: Column) -> Column:
    """The buckets of all character n-grams, host and path apart."""
    texts = (("host", F.concat(F.lit("^"), host, F.lit("$"))), ("path", F.concat(path, F.lit("$"))))
    return F.concat(*(_buckets(part, text, n) for part, text in texts for n in GRAMS))


def fit(spark: SparkSession, labelled: Sequence[tuple[str, int]] = LABELLED, regularisation: float = 0.01) -> tuple[list[float], float]:
    """Weights by bucket and the intercept, fitted on a small table of (url, 1 to block)."""
    table = spark.createDataFrame([(url, float(label)) for url, label in labelled], "url string, label double")
    rows = table.withColumn("grams", grams(url_host(F.col("url")), url_path(F.col("url"))))
    scale = F.sqrt(F.greatest(F.size("grams"), F.lit(1)))
    every = F.sequence(F.lit(0), F.lit(BUCKETS - 1))
    dense = F.transform(every, lambda b: F.size(F.filter("grams", lambda g: g == b)) / scale)
    rows = rows.select("label", array_to_vector(dense).alias("features"))
    model = LogisticRegression(regParam=regularisation, standardization=False, maxIter=60, aggregationDepth=2).fit(rows.coalesce(1))
    return [float(w) for w in model.coefficients.toArray()], float(model.intercept)


def block_score(host: Column, path: Column, weights: list[float], intercept: float) -> Column:
    """The probability that a url is to be blocked."""
    table = F.lit(weights)
    found = grams(host, path)
    total = F.aggregate(found, F.lit(0.0), lambda s, g: s + F.element_at(table, g + 1))
    margin = total / F.sqrt(F.greatest(F.size(found), F.lit(1))) + F.lit(intercept)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule of a short list of (verdict, ``host/path``), and its verdict.

    A rule fits its host and all subdomains if the path starts with the rule's
    path.  The list becomes one conditional expression, the longest rule first.
    """
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    labelled: Sequence[tuple[str, int]] = LABELLED,
    threshold: float = 0.5,
) -> DataFrame:
    """Return page_id, host, path, rule, score and verdict, one row per page."""
    weights, intercept = fit(pages.sparkSession, labelled)
    rows = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    scored = rows.select("*", rule.alias("rule"), verdict.alias("ruled"), block_score(F.col("host"), F.col("path"), weights, intercept).alias("score"))
    judged = F.coalesce("ruled", F.when(F.col("score") >= threshold, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", "score", judged.alias("verdict"))

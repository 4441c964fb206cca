"""URL filter: rules first, then logistic regression on hashed character n-grams.

Host and path are cut from the URL by fixed rules; A-Z in the host are lower-cased. A rule
``host/path`` fits its host and all its subdomains if the URL's path starts with the rule's
path; the longest rule wins, of equally long ones the alphabetically first. Without a rule the
classifier decides: n-grams of 3 to 5 characters of ``^host$`` and of the path, hashed into
``n_features`` counts, weighed by a logistic regression fitted to a small labelled URL table.
Everything runs as DataFrame operations and Spark ML inside the JVM.

A null URL, or one without ``://``, has an empty host and path; the classifier then sees the
n-grams of ``^$`` alone. Null and repeated ids are rows like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
N_FEATURES = 1 << 13

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The labelled URLs: label 1 is block.
BLOCKED = """
http://casino-royal.example.com/en/12.html
https://www.online-casino.example.org/play/slots
http://m.casino-win.example.net/bonus?id=4
https://best-casino.example.com/de/2210
http://free-bets.example.com/en/77
https://www.free-bets24.example.org/odds
http://sport-bets.example.net/live/1
https://betting-tips.example.com/fr/9
http://cheap-pills.example.com/buy/viagra
https://www.cheap-pills.example.org/de/31
http://pills-online.example.net/order
https://pharmacy-discount.example.com/pills/2
http://xxx-videos.example.com/watch/1
https://adult-cams.example.org/live/xxx
http://www.hot-porn.example.net/free
https://porn-tube.example.com/en/3
http://poker-stars-win.example.com/join
https://www.slots-jackpot.example.org/spin
http://win-money-fast.example.net/offer/1
https://free-money.example.com/prize/winner
http://payday-loans.example.com/apply
https://replica-watches.example.org/shop
http://torrent-warez.example.net/crack/serial
https://www.keygen-crack.example.com/download
http://ads-track.example.com/en/5
https://m.ads-server.example.org/click/8
https://www.track-ads.example.net/de/1
http://spam-farm.example.com/fr/9
https://link-farm.example.org/en/44.html
http://blog.spam-links.example.net/es/3
https://adult-x.example.com/en/6
http://www.adult-chat.example.org/de/2?page=2
https://casino-win.example.org/fr/70/
http://www.free-bets.example.com/es/18#top
https://blog.cheap-pills.example.net/en/262?utm_source=feed
http://bets-win.example.org/en/5
""".split()
ALLOWED = """
http://www.news-daily.example.com/en/2024/05/article.html
https://blog.gardening.example.org/fr/roses
http://m.weather.example.net/de/berlin
https://docs.library.example.com/en/guide/1
http://museum.example.org/es/exposiciones
https://www.university.example.com/research/paper/12
http://thering.example.net/en/7442.html
https://tionble.example.org/en/482/
http://blog.tionsh.example.com/fr/8798?page=2&ref=x
https://m.ththes.example.org/en/873
https://www.keitung.example.net/de/6137#top
http://oulement.example.com/fr/4163
https://ciones.example.org/es/5512.html
http://www.anthere.example.com/en/9931?utm_source=feed
https://history.example.net/en/medieval/castles
http://recipes.example.com/es/sopa/verduras
https://www.science.example.org/en/physics/quantum
http://maps.example.net/fr/paris/rues
https://wiki.example.com/de/Goethe
http://travel.example.org/en/italy/rome.html
https://forum.example.com/en/thread/3321/
http://www.erstlich.example.net/de/1373/
https://schule.example.org/de/mathe/1
http://parlement.example.com/fr/lois/2020
https://tiontion.example.net/en/7817?utm_source=feed
https://www.ththan.example.com/en/7944?page=2&ref=x
http://ththha.example.org/de/157
https://m.ththst.example.com/en/1837/
http://thther.example.com/en/55.html
https://www.ththre.example.org/es/3#top
http://blog.ththing.example.com/en/744
https://therst.example.net/fr/4163
http://theron.example.com/es/598
https://www.therble.example.org/en/31/
http://thernd.example.com/fr/12?utm_source=feed
https://m.therin.example.com/en/8.html
http://www.oneath.example.org/de/2
https://ander.example.com/en/90
http://eauque.example.com/fr/1373/
https://schaft.example.org/en/66#top
http://adoque.example.com/es/9?page=2&ref=x
https://books.example.org/en/novels/7
http://www.cooking.example.com/en/bread
""".split()


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    url = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    pattern = "^(?s:.*?)://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(url, pattern, 1), UPPER, LOWER), F.regexp_extract(url, pattern, 2)


def longest_rule(host: Column, path: Column, rules: Mapping[str, str] = RULES) -> Column:
    """The rule that decides, null if none fits."""
    result = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r), r), reverse=True):
        rule_host, _, rule_path = rule.partition("/")
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit("/" + rule_path))
        result = F.when(fits, F.lit(rule)).otherwise(result)
    return result


def rule_verdict(rule: Column, rules: Mapping[str, str] = RULES) -> Column:
    return F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])[rule]


def _grams(mark: str, text: Column, n: int) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
    return F.transform(starts, lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n))))


def n_grams(host: Column, path: Column, sizes: Sequence[int] = (3, 4, 5)) -> Column:
    """Character n-grams of the marked host and of the path, told apart by a first letter."""
    marked = F.concat(F.lit("^"), host, F.lit("$"))
    return F.concat(*[_grams("h", marked, n) for n in sizes], *[_grams("p", path, n) for n in sizes])


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in table (url, label), made from literals."""
    rows = [F.struct(F.lit(u).alias("url"), F.lit(y).alias("label")) for y, urls in ((1.0, BLOCKED), (0.0, ALLOWED)) for u in urls]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _featured(urls: DataFrame, n_features: int) -> DataFrame:
    return HashingTF(numFeatures=n_features, inputCol="grams", outputCol="features").transform(urls)


def fit(labelled: DataFrame, n_features: int = N_FEATURES) -> LogisticRegressionModel:
    """Fitted to (url, label); rows without either are left out."""
    host, path = host_and_path("url")
    rows = labelled.dropna(subset=["url", "label"]).select(n_grams(host, path).alias("grams"), F.col("label").cast("double").alias("label"))
    regression = LogisticRegression(regParam=0.02, maxIter=30, standardization=False)
    return regression.fit(_featured(rows, n_features).coalesce(1))


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules: Mapping[str, str] = RULES, n_features: int = N_FEATURES) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per page."""
    model = fit(labelled if labelled is not None else labelled_urls(pages.sparkSession), n_features)
    host, path = host_and_path("url")
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    rows = _featured(rows.withColumn("grams", n_grams(F.col("host"), F.col("path"))), n_features)
    learned = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return model.transform(rows).select(
        "page_id", "host", "path", "rule", F.coalesce(rule_verdict(F.col("rule"), rules), learned).alias("verdict")
    )

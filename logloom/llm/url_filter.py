"""URL filters: rules on host and path, and for the rest a logistic regression on hashed character n-grams.

Everything that touches the urls is DataFrame functions. The classifier is fitted by batch gradient steps on a small
labelled table: its n-grams are counted by Spark, each step is one join and two aggregations over it, and only the
``buckets`` weights (a fixed number) come to the driver and go back as one literal array.

Defined results: a null url, or one without ``://``, has an empty host and path and fits no rule; empty hosts and paths
have no n-gram, so the bias decides; repeated rows give repeated rows; a null id stays null; an empty table gives an
empty table; other columns are ignored. Very long urls cost time in proportion to their length.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm.common import ascii_lower

#: (host, path, verdict): a rule fits its host and all subdomains where the path starts with the rule's.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))

#: The default labelled table: urls of invented hosts, in the everyday words of what is to be blocked (gambling, pills, adult
#: pages, loans, cracks, fakes, link farms and trackers) and of ordinary pages. Both sides share subdomains, top-level
#: domains and numbered pages, which then tell nothing.
BLOCKED_URLS = """
http://grand-casino.net/en/101  https://www.casino-royal.com/bonus  http://m.casino777.org/de/12.html  https://blog.mycasino.net/fr/8  http://casino-bonus.com/spins  http://slots-casino.org/en/4
https://win-big.net/claim  http://www.win-cash.com/en/77  http://lucky-win.org/es/3  https://m.winners-club.net/spin  http://jackpot-win.com/fr/9  https://slotmania.com/free/spins
http://best-bets.net/en/5  https://www.sportsbets.com/odds  http://bets-online.org/de/61  https://m.betting-tips.net/es/7  http://blog.poker-room.com/en/1  https://pokerstake.org/deposit
http://free-spins.com/fr/2  https://www.free-money.net/en/31  http://free-iphone.org/win  https://free-gifts.net/claim/8  http://m.freecash.com/de/90  http://freebies-now.com/en/2
http://pills-online.com/en/14  https://www.diet-pills.net/order  http://m.pillstore.org/fr/6  https://bluepills.com/buy  http://blog.cheap-meds.net/es/44  https://cheapmeds.org/rx
http://cheap-viagra.com/en/3  https://www.cheap-watches.net/sale  http://cheap-loans.org/de/15  https://m.cheap-tickets4u.com/fr/28  http://superpharm-rx.net/en/9  https://no-rx-pharmacy.com/order/1
http://adult-chat.com/live  https://www.adult-cams.net/en/18  http://m.adultdating.org/es/2  https://blog.adults-only.com/de/4  http://adult-video.net/fr/11  https://hot-adult.org/en/6
http://xxx-tube.com/en/1  https://www.xxxvideos.net/fr/3  http://m.x-rated.com/de/8  https://sexy-x.org/en/20  http://porn-x.net/es/5  https://live-sex-cams.com/join
http://hotsingles.net/en/7  https://www.hookup-tonight.com/de/1  http://escort-girls.org/fr/16  https://milf-dates.com/en/2  http://m.nudechat.net/es/9  https://camgirls.org/en/30
http://spam-links.com/en/2  https://www.spamblast.net/fr/7  http://link-farm.org/de/33  https://m.linkfarms.com/en/8  http://blog.seo-farm.net/es/1  https://bulk-spam.com/list
http://ads-server.com/click  https://www.ads-pop.net/en/5  http://m.popads.org/fr/40  https://adclick-track.com/r/9  http://click-tracker.net/go  https://www.trackpixel.org/t/1
http://ad-tracker.com/en/2  https://bannerads.net/de/6  http://payday-loans.com/apply  https://www.quick-loan.net/en/12  http://fastcash-loans.org/es/3  https://m.nocredit-loan.com/fr/1
http://keygen-crack.com/dl  https://www.crackz.net/en/9  http://warez-zone.org/de/2  https://m.serial-keys.com/fr/5  http://torrent-crack.net/es/71  https://nulled-scripts.com/en/4
http://replica-watches.com/en/6  https://www.fake-rolex.net/buy  http://m.replicabags.org/fr/2  https://fakediploma.com/order  http://blog.replica-shoes.net/de/9  https://designer-fakes.com/en/3
http://bitcoin-doubler.com/en/8  https://www.crypto-giveaway.net/claim  http://get-rich-fast.org/es/6  https://m.earn-cash.com/fr/10  http://miracle-cure.net/en/1  https://lose-weight-fast.com/de/5
""".split()
PLAIN_URLS = """
http://northern-herald.net/en/101  https://www.theatre-club.com/season  http://m.otherside.org/de/12.html  https://blog.thistle.net/fr/8  http://weather-station.com/today  http://heron-lake.org/en/4
https://city-library.net/hours  http://www.museum-guide.com/en/77  http://riverside.org/es/3  https://m.gardenclub.net/plants  http://mapleton-school.com/fr/9  https://oldmill.com/history
http://university-press.net/en/5  https://www.townhall.com/minutes  http://harbour-news.org/de/61  https://m.trailmaps.net/es/7  http://blog.stonebridge.com/en/1  https://wikinotes.org/edit
http://recipes-at-home.com/fr/2  https://www.bakery-lane.net/en/31  http://kitchen-table.org/soup  https://opentools.net/docs/8  http://m.devnotes.com/de/90  http://codebook.com/en/2
http://cycling-routes.com/en/14  https://www.mountain-hut.net/booking  http://m.railways.org/fr/6  https://busroutes.com/lines  http://blog.birdwatch.net/es/44  https://botany.org/species
http://history-forum.com/en/3  https://www.chess-club.net/games  http://parish-records.org/de/15  https://m.village-hall.com/fr/28  http://localnews.net/en/9  https://the-courier.com/sport/1
http://anthology.com/poems  https://www.thirteen.net/en/18  http://m.thermal-baths.org/es/2  https://blog.thunder.com/de/4  http://threshold.net/fr/11  https://thatched-roofs.org/en/6
http://leather-works.com/en/1  https://www.northwind.net/fr/3  http://m.southern-coast.com/de/8  https://brother-and-son.org/en/20  http://either-or.net/es/5  https://withinreach.com/join
http://lantern.net/en/7  https://www.thornton.com/de/1  http://earthworks.org/fr/16  https://hearth-and-home.com/en/2  http://m.healthcare-trust.net/es/9  https://breath.org/en/30
http://handworks.com/en/2  https://www.anders.net/fr/7  http://wanderings.org/de/33  https://m.islands.com/en/8  http://blog.sandstone.net/es/1  https://hinterland.com/list
http://edition.com/archive  https://www.stations.net/en/5  http://m.nationalparks.org/fr/40  https://traditions.com/r/9  http://conditions.net/report  https://www.relations.org/t/1
http://inner-circle.com/en/2  https://interesting.net/de/6  http://entering.com/visit  https://www.whereabouts.net/en/12  http://elsewhere.org/es/3  https://m.nowhere-else.com/fr/1
http://readers-digest-club.com/new  https://www.estuary.net/en/9  http://foresters.org/de/2  https://m.ashtree.com/fr/5  http://shoreline.net/es/71  https://fishermen.com/en/4
http://table-tennis.com/en/6  https://www.stable-yard.net/riding  http://m.noble-prints.org/fr/2  https://ably.com/status  http://blog.familyhouse.net/de/9  https://lyceum.com/en/3
http://outdoor-notes.com/en/8  https://www.orchard.net/apples  http://ornithology.org/es/6  https://m.southport.com/fr/10  http://theology.net/en/1  https://ethics-review.com/de/5
""".split()


def labelled_urls() -> list[tuple[str, int]]:
    """The default labelled url table (1: block)."""
    return [(u, 1) for u in BLOCKED_URLS] + [(u, 0) for u in PLAIN_URLS]


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without a ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return ascii_lower(host), path


def matched(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    longest_first = sorted(rules, key=lambda r: (-len(r[0]) - len(r[1]), r))
    for name, prefix, verdict in reversed(longest_first):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(prefix))
        out = F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def grams(host: Column, path: Column, sizes: Sequence[int], buckets: int) -> Column:
    """Bucket of every character n-gram of host and of path; each kind has its own mark, hosts and paths end in ``$``."""

    def of(text: Column, mark: str, n: int) -> Column:
        chars = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")
        joined = chars
        for k in range(1, n):  # the last ones meet no partner and turn null
            joined = F.zip_with(joined, F.slice(chars, k + 1, F.greatest(F.size(chars) - k, F.lit(0))), lambda a, b: F.concat(a, b))
        whole = F.filter(joined, lambda g: g.isNotNull())
        held = F.when(F.length(text) > 0, whole).otherwise(F.array().cast("array<string>"))
        return F.transform(held, lambda g: F.pmod(F.xxhash64(F.concat(F.lit(mark), g)), F.lit(buckets)).cast("int"))

    return F.concat(*[of(text, mark, n) for text, mark in ((host, "h"), (path, "p")) for n in sizes])


def constant(values: Sequence[float]) -> Column:
    """A literal array of doubles: one folded constant instead of an expression for each value."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def default_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(labelled_urls(), "url string, label int")


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "label", max_rows: int = 10_000, sizes: Sequence[int] = (3, 4), buckets: int = 2048, steps: int = 16, rate: float = 40.0, decay: float = 1e-3) -> list[float]:
    """Weights of the buckets, and the bias last. ``max_rows`` bounds the labelled rows that are used, by a hash of the url.

    Rows with a null url or label take no part; without any row all weights are 0.
    """
    rows = labelled.select(labelled[url_col].alias("url"), labelled[label_col].cast("double").alias("y")).dropna().orderBy(F.xxhash64("url"), "url", "y").limit(max_rows)
    rows = rows.withColumn("id", F.monotonically_increasing_id())
    host, path = parts(F.col("url"))
    counted = rows.withColumn("g", grams(host, path, sizes, buckets)).select("id", "y", F.explode("g").alias("b"), (1.0 / F.sqrt(F.size("g").cast("double"))).alias("x"))
    counted = counted.groupBy("id", "y", "b").agg(F.sum("x").alias("x")).coalesce(1).cache()
    weights, bias = [0.0] * buckets, 0.0
    n = counted.select("id").distinct().count()
    for _ in range(steps if n else 0):
        z = F.sum(F.col("x") * F.element_at(constant(weights), F.col("b") + 1)) + bias
        each = counted.groupBy("id", "y").agg((1.0 / (1.0 + F.exp(-z)) - F.first("y")).alias("e"), F.collect_list(F.struct("b", "x")).alias("f"))
        moves = F.concat("f", F.array(F.struct(F.lit(buckets).alias("b"), F.lit(0.1).cast("double").alias("x"))))
        gradient = each.select("e", F.explode(moves).alias("f")).groupBy("f.b").agg(F.sum(F.col("e") * F.col("f.x")).alias("g")).collect()  # at most buckets + 1 rows
        weights = [w * (1 - decay) for w in weights]
        for b, g in gradient:
            if b == buckets:
                bias -= rate * g / n
            else:
                weights[b] -= rate * g / n
    counted.unpersist()
    return [*weights, bias]


def judge(urls: DataFrame, weights: Sequence[float], rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", sizes: Sequence[int] = (3, 4), threshold: float = 0.5) -> DataFrame:
    """id, host, path, rule, verdict, score (probability of block by the classifier, for every url); narrow, no shuffle."""
    buckets = len(weights) - 1
    limit = math.log(threshold / (1 - threshold))
    host, path = parts(F.col("url"))
    df = urls.select(urls[id_col].alias("id"), urls[url_col].cast("string").alias("url")).select("id", host.alias("host"), path.alias("path"))
    w = constant(weights[:-1])
    df = df.withColumn("g", grams(F.col("host"), F.col("path"), sizes, buckets))
    total = F.aggregate("g", F.lit(0.0), lambda a, b: a + F.element_at(w, b + 1))
    df = df.withColumn("z", total / F.greatest(F.sqrt(F.size("g").cast("double")), F.lit(1.0)) + float(weights[-1]))
    df = df.withColumn("m", matched(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("m.verdict"), F.when(F.col("z") >= limit, "block").otherwise("allow"))
    return df.select(F.col("id").alias(id_col), "host", "path", F.col("m.rule").alias("rule"), verdict.alias("verdict"), (1.0 / (1.0 + F.exp(-F.col("z")))).alias("score"))

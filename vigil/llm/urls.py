"""URL filter: host and path rules first, then logistic regression on hashed character n-grams.

Every 3- to 5-gram of ``<host>`` and of the path is hashed to one of 4,096 slots; a URL's score is the sum of its slots'
weights and the bias. Weights come from a small labelled table (``LABELLED``, or any list of at most ``MOST_LABELLED`` pairs)
by full-batch gradient descent and are rounded to integers, so a score is the same in any engine and order. Judging is one
projection of built-in functions: no shuffle, no Python.

Defined results: a null URL, or one without ``://``, has an empty host and path and is judged by the bias alone (allow);
ids may repeat or be null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import pages

SLOTS = 4096
GRAMS = (3, 4, 5)
SCALE = 10_000
MOST_LABELLED = 10_000
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# The labelled table: host and path of URLs to block and to allow, labelled by hand; almost every one is another site.
_BLOCK = """
royal-casino.bet/slots/spin  play.royal-casino.bet/bonus/free-spins  luckyslots777.example/jackpot/  www.poker-stars-bonus.example/signup
bet-on-sports.example/odds/live  m.bestbets.example/free-bets/today  jackpotcity-online.example/casino/roulette  slots.vegas-win.example/play
online-casino-bonus.example/no-deposit  lottery-winner.example/claim/prize  www.win-prize-now.example/iphone/claim.php  free-money-fast.example/click
cheap-meds-online.example/viagra/buy  buy-viagra.example/order/pills  www.cheap-pills.example/cialis/no-prescription  pharmacy-discount-rx.example/meds/cheap
weightloss-pills.example/order-now  rx-pills-store.example/generic/viagra  adult-videos.example/xxx/hd  www.xxx-tube.example/porn/watch
sexcam-live.example/girls/online  porn-hd.example/free/video/  hot-adult-dating.example/join  webcam-sex-chat.example/adult/room
ads.adserver-one.example/banner/click  adserver.trackmedia.example/pixel.gif  tracker.clickcount.example/track/click  popunder-ads.example/serve.js
pixel.adtracker.example/collect  cdn.popads.example/popunder.js  banner-click.example/ads/redirect  track.affiliate-clicks.example/offer
spamfarm-links.example/seo/backlinks  buy-backlinks-cheap.example/seo/spam  linkfarm.spamblog.example/keywords/  bulk-mail-spam.example/lists/buy
payday-loan-fast.example/apply  instant-payday-loans.example/cash/now  quick-cash-loans.example/no-credit-check  free-crypto-giveaway.example/double/btc
warez-download.example/crack/keygen  cracked-software.example/serial/keygen  free-warez.example/full/crack.exe  torrent-warez.example/download/cracked
replica-watches-cheap.example/rolex  fake-designer-bags.example/cheap/buy  verify-account-login.example/secure/bank/update.php  bank-login-confirm.example/signin/verify
m.blackjack-live.example/casino/tables  www.bingo-bonus.example/free/signup  betting-tips-vip.example/odds/today  roulette-strategy.example/win/jackpot
poker-room-online.example/play/bonus  sports-betting-odds.example/live/bets  viagra-generic.example/buy/cheap  www.diet-pills-fast.example/order/pills
no-prescription-meds.example/rx/  erotic-stories-xxx.example/adult/  free-porn-clips.example/watch/hd  m.sexchat.example/girls/live
adclick.example/banner/redirect  www.popup-ads-server.example/serve/ad.js  track-visits.example/pixel/track  spam-comments-bot.example/seo/links
cash-advance-loan.example/apply/fast  win-free-phone.example/prize/claim  keygen-cracks.example/warez/serial  secure-login-update.example/bank/verify
prize-survey.example/winner/claim  download-free-codec.example/setup.exe  pc-cleaner-alert.example/virus/warning  free-bets-casino.example/promo
"""
_ALLOW = """
www.city-library.example/catalogue/new  library.northfield.example/opening-hours  daily-news.example/politics/2023/05/article  news.harbour-post.example/world/story-118
www.riverside-school.example/parents/calendar  physics.uni-lakeside.example/lectures/quantum  university-press.example/journals/biology  museum-of-science.example/exhibitions/space
weather.coastal.example/forecast/week  climate-data.example/reports/rainfall  garden-diary.example/roses/pruning  family-recipes.example/soups/lentil
baking-at-home.example/bread/sourdough  www.hill-walks.example/routes/north  train-times.example/stations/central  city-council.example/planning/applications
health-service.example/advice/flu  hospital-trust.example/departments/cardiology  history-society.example/archive/1890  local-archive.example/photos/harbour
docs.parserkit.example/reference/api  wiki.openmaps.example/index/Main_Page  forum.woodwork.example/thread/4411  blog.slow-travel.example/spain/granada
maths-for-all.example/algebra/lesson-3  language-exchange.example/spanish/verbs  chess-club.example/results/2022  football-league.example/fixtures/may
theatre-royal.example/season/hamlet  concert-hall.example/programme/brahms  bookshop.example/fiction/authors  poetry-review.example/issues/spring
astronomy-club.example/observing/mars  bird-watchers.example/species/heron  geology-notes.example/minerals/quartz  photo-walks.example/gallery/autumn
software-manual.example/install/linux  code-notes.example/python/iterators  www.statistics-office.example/tables/population  parliament-records.example/debates/2021
court-reports.example/cases/summary  open-data.example/datasets/transport  village-hall.example/events/june  parish-church.example/services/sunday
cycling-routes.example/maps/river  sailing-school.example/courses/beginner  pet-care.example/dogs/puppies  dental-advice.example/children/teeth
www.miller-roofing.example/contact  m.garcia.example/de/14  novak-law.example/team/  blog.johnson-family.example/posts/203
www.dubois.example/about?x=1  schneider-optik.example/fr/work  bristol-dental.example/prices  www.kowalski.example/en/88
lindqvist.example/estate/history  m.portsmouth.example/oysters  lisbon-hotel.example/rooms/12  www.cornwall.example/beaches/en/
rossi-brothers.example/joinery  www.leicester.example/local/61/  emma-clarke.example/music  highland-wool.example/yarn/7
www.salisbury.example/market  blog.hoffmann.example/de/501  yamamoto.example/ceramics  peterson-tools.example/catalog/3
tea-house.example/menu/green-tea  film-archive.example/directors/silent  job-centre.example/vacancies/teacher  science-magazine.example/articles/ocean
"""
LABELLED = tuple((f"https://{site}", label) for label, table in ((1, _BLOCK), (0, _ALLOW)) for site in table.split())


def site(url: str) -> str:
    """The last two parts of the host: URLs of one site stay on one side of a held-out split."""
    return ".".join(split_url(url)[0].split(".")[-2:])


def features(host: str, path: str) -> list[int]:
    """The slots of a URL's n-grams, in plain Python: for training and as the other side of tests."""
    out = []
    for text in (f"<{host}>", path):
        for n in GRAMS:
            for i in range(len(text) - n + 1):
                out.append(int(hashlib.md5(text[i : i + n].encode()).hexdigest()[:3], 16))
    return out


def split_url(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    end = min([i for i in (rest.find(c, cut) for c in "?#") if i >= 0], default=len(rest))
    return rest[:cut].translate(str.maketrans(UPPER, LOWER)), rest[cut:end]


@cache
def fit(labelled: Sequence[tuple[str, int]] = LABELLED, steps: int = 400, rate: float = 0.5, decay: float = 1e-3) -> tuple[tuple[int, ...], int]:
    """Integer weights by slot, and the bias, from pairs of URL and label (1: block)."""
    if len(labelled) > MOST_LABELLED:
        raise ValueError(f"at most {MOST_LABELLED} labelled URLs")
    x = np.zeros((len(labelled), SLOTS))
    for row, (url, _) in enumerate(labelled):
        for slot in features(*split_url(url)):
            x[row, slot] += 1
    y = np.array([label for _, label in labelled], float)
    norm = np.sqrt(x.sum(axis=1).mean()) if len(labelled) else 1.0
    w, bias = np.zeros(SLOTS), 0.0
    for _ in range(steps if len(labelled) else 0):
        error = 1 / (1 + np.exp(-(x @ w + bias))) - y
        w -= rate * (x.T @ error / len(y) / norm + decay * w)
        bias -= rate * error.mean() / norm
    return tuple(int(v) for v in np.round(w * SCALE)), int(round(bias * SCALE))


def host_and_path(url: Column) -> tuple[Column, Column]:
    found = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(found, PARTS, 1), UPPER, LOWER), F.regexp_extract(found, PARTS, 2)


def score(host: Column, path: Column, model: tuple[tuple[int, ...], int]) -> Column:
    """The score of a URL, times ``SCALE``; above zero means block."""
    weights = F.split(F.lit(",".join(map(str, model[0]))), ",").cast("array<int>")

    def of(text: Column, n: int) -> Column:
        places = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(F.array().cast("array<int>"))

        def add(acc: Column, i: Column) -> Column:
            slot = F.conv(F.substring(F.md5(F.substring(text, i, F.lit(n)).cast("binary")), 1, 3), 16, 10).cast("int")
            return acc + F.element_at(weights, slot + 1)

        return F.aggregate(places, F.lit(0).cast("long"), add)

    texts = (F.concat(F.lit("<"), host, F.lit(">")), path)
    return sum((of(text, n) for text in texts for n in GRAMS), F.lit(model[1]).cast("long"))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (null if none) and its verdict."""
    name = verdict = F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def judged(df: DataFrame, id: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str]] = RULES, model=None) -> DataFrame:
    """One row per input row: id, host, path, rule and verdict."""
    model = model or fit()
    host, path = host_and_path(F.col(url))
    parts = df.select(F.col(id).alias("id"), host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    own = F.when(score(F.col("host"), F.col("path"), model) > 0, "block").otherwise("allow")
    return parts.select(F.col("id").alias(id), "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"))


def op8_url_filter(spark, folder):
    return judged(pages(spark, folder))


def _sql() -> str:
    weights, bias = fit()
    sums = "".join(
        f" + coalesce(list_sum(list_transform(range(1, length({t}) - {n - 2}),"
        f" lambda i: w[('0x' || substr(md5(substr({t}, i, {n})), 1, 3))::INTEGER + 1])), 0)"
        for t in ("'<' || host || '>'", "path")
        for n in GRAMS
    ).replace("length('<' || host || '>')", "(length(host) + 2)").replace("substr('<' || host || '>'", "substr(('<' || host || '>')")
    return rf"""
        WITH p AS (
            SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages
        ), r(verdict, domain, prefix) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
            ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
        m AS (SELECT p.*, (SELECT max_by(domain || prefix || ' ' || verdict, length(domain || prefix)) FROM r
              WHERE (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, prefix)) AS best FROM p),
        k AS (SELECT [{",".join(map(str, weights))}] AS w),
        s AS (SELECT m.*, {bias}{sums} AS score FROM m, k)
        SELECT page_id, host, path, split_part(best, ' ', 1) AS rule,
               CASE WHEN best IS NOT NULL THEN split_part(best, ' ', 2) WHEN score > 0 THEN 'block' ELSE 'allow' END AS verdict FROM s
    """


QUERIES = {"op8_url_filter": op8_url_filter}
ORACLE = {"op8_url_filter": _sql()}

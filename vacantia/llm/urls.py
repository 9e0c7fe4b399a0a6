"""URL filter: host/path rules first, then logistic regression on hashed character n-grams of host and path.

The model is trained in numpy from LABELLED, a small table of labelled URLs; training is deterministic, takes well under
a second and happens once in each Python worker, so nothing is broadcast. A rule decides where one fits; the model
decides elsewhere.

A null url, or one without ``://``, has an empty host and path: no rule fits, and the model's verdict on empty strings is
allow (its bias). Repeated rows give repeated results; an empty table gives an empty one; long urls are read whole. Only
the id and url columns are read, so that others can't clash.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: (verdict, host, path start): fits the host and its subdomains where the path starts so; the longest host + path wins.
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
#: (label, url): 1 is unwanted. Synthetic.
LABELLED = (
    (1, "https://www.cheap-tablets.example.com/buy/now"), (1, "http://cheap-meds.example.org/order"), (1, "https://pills-online.example.net/en/12"), (1, "http://discount-pharmacy.example.com/fr/3"),
    (1, "https://spam-fields.example.org/en/728"), (1, "http://link-farm.example.net/index"), (1, "https://seo-spam.example.com/de/5"), (1, "http://spam-links.example.org/es/44"),
    (1, "https://casino-bonus.example.com/play"), (1, "http://best-casino.example.net/slots"), (1, "https://poker-win.example.org/en/9"), (1, "http://betting-tips.example.com/free"),
    (1, "https://xxx-videos.example.net/watch"), (1, "http://adult-cams.example.com/live"), (1, "https://hot-dating.example.org/en/77"), (1, "http://free-porn.example.net/es/8"),
    (1, "https://replica-watches.example.com/shop"), (1, "http://fake-bags.example.org/sale"), (1, "https://payday-loans.example.net/apply"), (1, "http://quick-cash.example.com/loan"),
    (1, "https://warez-crack.example.org/keygen"), (1, "http://torrent-free.example.net/download"), (1, "https://click-bait.example.com/win-prize"), (1, "http://free-prize.example.org/claim"),
    (1, "https://ad-tracker.example.net/click"), (1, "http://ads.example.com/banner"), (1, "https://malware-host.example.org/exe"), (1, "http://phish-login.example.net/verify"),
    (1, "http://meds-cheap.example.net/pills"), (1, "https://online-pharmacy.example.com/discount"), (1, "http://order-pills.example.org/cheap"), (1, "https://pharmacy-meds.example.net/buy"),
    (1, "http://farm-links.example.com/spam"), (1, "https://spam-seo.example.net/links"), (1, "http://seo-links.example.org/farm"), (1, "https://buy-links.example.com/seo"),
    (1, "http://casino-slots.example.org/bonus"), (1, "https://online-poker.example.net/casino"), (1, "http://slots-win.example.com/play"), (1, "https://betting-bonus.example.org/poker"),
    (1, "http://sport-betting.example.net/win"), (1, "https://adult-videos.example.com/xxx"), (1, "http://porn-cams.example.org/live"), (1, "https://adult-dating.example.net/hot"),
    (1, "http://xxx-porn.example.com/free"), (1, "https://fake-watches.example.net/replica"), (1, "http://replica-bags.example.com/sale"), (1, "https://cash-loans.example.org/payday"),
    (1, "http://quick-loan.example.net/cash"), (1, "https://payday-cash.example.com/loans"), (1, "http://crack-keygen.example.com/warez"), (1, "https://free-torrent.example.org/warez"),
    (1, "http://download-crack.example.net/torrent"), (1, "https://win-prize.example.net/click"), (1, "http://claim-prize.example.com/free"), (1, "https://click-tracker.example.org/ads"),
    (1, "http://ad-banner.example.net/tracker"), (1, "https://phish-verify.example.com/login"), (1, "http://malware-exe.example.net/download"), (1, "https://login-phish.example.org/malware"),
    (1, "http://cheap-pills-shop.example.net/order"), (1, "https://meds-order.example.com/buy"), (1, "http://buy-cheap-meds.example.net/pills"), (1, "https://discount-pills.example.org/pharmacy"),
    (1, "http://spam-list.example.net/index"), (1, "https://links-farm.example.org/en/4"), (1, "http://seo-farm.example.com/links"), (1, "https://spammy-seo.example.org/de/31"),
    (1, "http://casino-online.example.com/slots"), (1, "https://poker-casino.example.com/bonus"), (1, "http://free-slots.example.net/casino"), (1, "https://sports-betting.example.com/tips"),
    (1, "http://betting-win.example.org/bonus"), (1, "https://live-cams.example.net/xxx"), (1, "http://dating-hot.example.com/adult"), (1, "https://porn-videos.example.org/watch"),
    (1, "http://adult-porn.example.net/videos"), (1, "https://replica-shop.example.org/watches"), (1, "http://fake-replica.example.net/bags"), (1, "https://watches-sale.example.com/fake"),
    (1, "http://payday-loan.example.org/quick"), (1, "https://loans-cash.example.net/apply"), (1, "http://keygen-warez.example.net/crack"), (1, "https://torrent-download.example.com/crack"),
    (1, "http://prize-win.example.org/claim"), (1, "https://free-prize-click.example.com/win"), (1, "http://ad-click.example.org/banner"), (1, "https://tracker-ads.example.com/click"),
    (1, "http://verify-login.example.org/phish"), (1, "https://exe-malware.example.com/download"),
    (0, "https://www.weaver.example.com/en/148.html"), (0, "http://blog.northern.example.net/en/960"), (0, "https://m.theatre.example.com/en/474.html"), (0, "https://heather.example.org/fr/414"),
    (0, "https://blog.stations.example.net/es/533/"), (0, "http://oldmill.example.org/de/252?page=2"), (0, "https://www.artists.example.org/en/334/"), (0, "http://harbour.example.net/en/231"),
    (0, "https://news.daily.example.com/2024/05/story"), (0, "http://www.library.example.org/catalogue/12"), (0, "https://docs.project.example.net/guide/install"), (0, "http://university.example.org/research/papers"),
    (0, "https://museum.example.com/collection/item/7"), (0, "http://cooking.example.net/recipes/bread"), (0, "https://gardening.example.org/tips/roses"), (0, "http://history.example.com/articles/1848"),
    (0, "https://science.example.net/physics/waves"), (0, "http://travel.example.org/cities/rome"), (0, "https://music.example.com/scores/bach"), (0, "http://weather.example.net/forecast/today"),
    (0, "https://www.council.example.org/services/parks"), (0, "http://school.example.com/timetable"), (0, "https://forum.example.net/t/4821"), (0, "http://wiki.example.org/page/Main"),
    (0, "https://tionand.example.org/en/728"), (0, "http://m.ththing.example.org/en/12.html"), (0, "https://inonble.example.net/en/9"), (0, "http://hererth.example.org/es/44"),
    (0, "https://www.onthat.example.com/en/77?utm_source=feed"), (0, "http://tithes.example.net/de/5/"), (0, "https://readers.example.org/en/book-club"), (0, "http://notable.example.org/people/12"),
    (0, "https://entblei.example.net/fr/3"), (0, "http://blog.ithwast.example.org/en/15#top"), (0, "https://station.example.net/timetable"), (0, "http://nation.example.com/press"),
    (0, "https://table.example.org/bookings"), (0, "http://www.thonre.example.org/en/901"), (0, "https://m.ourand.example.com/es/27"), (0, "http://stables.example.net/horses"),
    (0, "https://blog.researchers.example.com/de/83"), (0, "http://ononer.example.net/es/797"), (0, "https://erthan.example.org/en/61"), (0, "http://www.ingand.example.com/fr/19"),
    (0, "https://www.orchard.example.com/en/apples/4"), (0, "http://bakery.example.net/menu"), (0, "https://choir.example.org/concerts/spring"), (0, "http://m.villager.example.com/en/310"),
    (0, "https://astronomy.example.net/en/moons"), (0, "http://chess.example.org/openings/12"), (0, "https://blog.walkers.example.com/routes/9.html"), (0, "http://pottery.example.net/classes"),
    (0, "https://railway.example.org/en/556/"), (0, "http://www.mountain.example.com/maps"), (0, "https://insects.example.net/de/18"), (0, "http://lighthouse.example.org/fr/91"),
    (0, "https://quilting.example.com/patterns/star"), (0, "http://m.harvest.example.net/en/27.html"), (0, "https://geology.example.org/rocks/basalt"), (0, "http://theorem.example.com/proofs/3"),
    (0, "https://www.fishermen.example.net/tides"), (0, "http://orchestra.example.com/season/2023"), (0, "https://castle.example.org/visit"), (0, "http://blog.potter.example.net/es/64"),
    (0, "https://translation.example.com/en/verbs"), (0, "http://birds.example.org/sightings/2021"), (0, "https://sailing.example.net/knots"), (0, "http://www.county.example.com/minutes/88"),
    (0, "https://anthem.example.org/en/5#verse"), (0, "http://linen.example.net/weaving"), (0, "https://m.rivers.example.com/levels"), (0, "http://grammar.example.org/fr/702"),
    (0, "https://kitchen.example.net/recipes/soup?page=3"), (0, "http://alphabet.example.com/letters"), (0, "https://winter.example.org/en/119"), (0, "http://eastern.example.net/timetable/bus"),
    (0, "https://www.historian.example.com/de/1066"), (0, "http://shelter.example.org/animals"), (0, "https://observer.example.net/en/2020/07/review"), (0, "http://m.mathematics.example.com/sets"),
    (0, "https://thunder.example.org/storms/4"), (0, "http://feather.example.net/en/38/"), (0, "https://inventors.example.com/patents/lamp"), (0, "http://blog.teacher.example.org/lessons/21"),
)
BUCKETS, SIZES, ROUNDS, RATE, PENALTY, THRESHOLD = 1 << 14, (3, 4, 5), 400, 1.5, 1e-4, 0.55
SCHEMA = "page_id long, host string, path string, rule string, verdict string, score double"
_PARTS = re.compile(r"://([^/?#]*)([^?#]*)", re.S)


def split_url(url: str | None) -> tuple[str, str]:
    found = _PARTS.search(url) if url else None
    return (found[1].encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"), found[2]) if found else ("", "")


def fitting_rule(host: str, path: str) -> tuple[str, str] | None:
    """(verdict, rule) of the longest rule that fits."""
    fits = [(len(h + p), v, h + p) for v, h, p in RULES if (host == h or host.endswith(f".{h}")) and path.startswith(p)]
    return max(fits)[1:] if fits else None


def features(host: str, path: str) -> np.ndarray:
    """Distinct buckets of the n-grams of host and path, which are marked so that they never share one by form."""
    grams = {f"{k}{n}{s[i : i + n]}" for k, s in (("h", f"^{host}$"), ("p", f"^{path}$")) for n in SIZES for i in range(len(s) - n + 1)}
    return np.unique([zlib.crc32(x.encode("utf-8", "surrogatepass")) % BUCKETS for x in grams]).astype(np.int64) if grams else np.zeros(0, np.int64)


@lru_cache(maxsize=1)
def model() -> tuple[np.ndarray, float]:
    """Weights and bias; full-batch gradient descent on features of unit length."""
    rows = [features(*split_url(u)) for _, u in LABELLED]
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, at in enumerate(rows):
        x[i, at] = len(at) ** -0.5
    y = np.array([label for label, _ in LABELLED], np.float32)
    w, bias = np.zeros(BUCKETS, np.float32), 0.0
    for _ in range(ROUNDS):
        off = 1 / (1 + np.exp(-(x @ w + bias))) - y
        w -= RATE * len(y) ** 0.5 * (x.T @ off / len(y) + PENALTY * w)
        bias -= RATE * float(off.mean())
    return w, bias


def score(host: str, path: str) -> float:
    w, bias = model()
    at = features(host, path)
    return float(1 / (1 + np.exp(-(w[at].sum() * max(1, len(at)) ** -0.5 + bias)))) if host or path else 0.0


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for url in batch.column(1).to_pylist():
            host, path = split_url(url)
            rule, p = fitting_rule(host, path), score(host, path)
            out.append((host, path, rule and rule[1], rule[0] if rule else "block" if p >= THRESHOLD else "allow", p))
        kinds = [pa.string()] * 4 + [pa.float64()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, k) for x, k in zip(zip(*out) if out else [()] * 5, kinds))], ["page_id", "host", "path", "rule", "verdict", "score"])


def judge_urls(pages: DataFrame) -> DataFrame:
    """A row for each page: host, path, the rule that fits, the verdict and the model's probability."""
    return pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url").mapInArrow(_rows, SCHEMA)

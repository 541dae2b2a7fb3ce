"""URL verdicts against a plain version; the cascade against set membership."""

import random
import re

import numpy as np

from telemetra.llm import url_filter as urls

ODD = [None, "", "no scheme", "http://", "HTTP://A.Net/x", "http://net/", "http://net", "http://x.net?/", "http://xnet/", "http://example.net/en/a/b?c#d",
       "http://m.EXAMPLE.net/en", "http://example.net/en/", "http://example.com/de/1", "http://a.org/fr/", "http://a.org/FR/", "a://b://c.net/x",
       "http://Spam-Farm.example.org:80/x", "http://spam-farm.example.org/x", "http://deep.sub.spam-farm.example.org", "http://notspam-farm.example.org/",
       "http://cheap-pills.example.net/en/x", "http://adult-x.example.com/de/", "http://É.org/x", "http://a..b/", "x://#", "http://a\nb.net/q\n?z"]


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in re.split("[/?#]", rest)[0])
    path = re.split("[?#]", rest[len(host):])[0]
    best = max((r for r in urls.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])),
               key=lambda r: len(r[1] + r[2]), default=None)
    listed = any(host == d or host.endswith("." + d) for d in urls.LISTED)
    return host, path, best and best[1] + best[2], best[0] if best else "block" if listed else "allow"


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "key string")


def test_verdicts(spark):
    rows = [*enumerate(ODD), (None, "http://a.net/1"), (3, "http://"), (3, "http://")]
    df = spark.createDataFrame([(i, u, "clash", True) for i, u in rows], "page_id long, url string, host string, listed boolean")
    got = sorted((str(r.page_id), *map(str, r[1:])) for r in urls.judge(df, keys(spark, [*urls.LISTED, None, "absent.example.org", "adult-x.example.com"])).collect())
    assert got == sorted((str(i), *map(str, plain(u))) for i, u in rows)
    assert urls.judge(df.limit(0), keys(spark, urls.LISTED)).collect() == []
    assert {r.verdict for r in urls.judge(df.where("page_id = 17"), keys(spark, [])).collect()} == {"allow"}


def test_cascade_is_exact_for_every_key(spark):
    rnd = random.Random(3)
    hosts = [f"h{rnd.randrange(10 ** 6)}.site{rnd.randrange(400)}.{rnd.choice(['com', 'org'])}" for _ in range(3000)]
    universe = {".".join(h.split(".")[i:]) for h in hosts for i in range(2)}
    for share in (0.01, 0.5):
        listed = {k for k in universe if rnd.random() < share}
        df = spark.createDataFrame(list(enumerate(hosts)), "page_id long, host string")
        got = {r.page_id: r.listed for r in urls.listed_hosts(df, keys(spark, listed)).collect()}
        assert got == {i: h in listed or h.split(".", 1)[1] in listed for i, h in enumerate(hosts)}


def test_split_over_several_cascades(spark, monkeypatch):
    monkeypatch.setattr(urls, "MAX_BITS", 4096)
    hosts = [f"h{i}.example.com" for i in range(900)]
    df = spark.createDataFrame(list(enumerate(hosts)), "page_id long, host string")
    got = {r.page_id for r in urls.listed_hosts(df, keys(spark, hosts[::3])).where("listed").collect()}
    assert got == set(range(0, 900, 3))


def test_no_level_lists_nothing():
    assert not urls.Cascade().listed(np.arange(5, dtype=np.uint64), np.arange(5, dtype=np.uint64)).any()

import random

from hypothesis import given
from hypothesis import strategies as st

from ledgerlens.llm import url_rules
from ledgerlens.llm.url_rules import ADDRESSES, ALLOW, BLOCK, UNWANTED, Index, address, address_rule, judge_urls, pattern_rule

RULES = [address_rule(h, p, v) for v, h, p in ADDRESSES] + list(UNWANTED)
PAGES = "page_id long, url string, html string, host string, rule long"


def plain(url):
    """Every rule by string operations, none fetched by a token."""
    host, path = address(url)
    fits = [
        (len(h + p), v, h + p)
        for v, h, p in ADDRESSES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if fits:
        _, verdict, text = max(fits)
        return host, path, text, verdict
    labels = host.split(".")
    bad = any(x.startswith(("adult-", "ads-", "casino-", "spam-")) for x in labels)
    return host, path, None, BLOCK if bad or "-bets." in host or "-pills." in host else ALLOW


HOSTS = ["org", "example.org", "www.Example.ORG", "notexample.org", "a.com", "adult-x.net", "free-bets.net", "m.ads-y.com", "x.net", ""]
PATHS = ["", "/", "/es/", "/es", "/en/1", "/en/12?x", "/en/2", "/fr/1", "/FR/1", "/de/", "#/de/", "?/de/", "/de//adult-", "/en/%31"]


def test_address():
    assert address("http://A.Org/x/Y?z#q") == ("a.org", "/x/Y")
    assert address("x://://y") == ("", "") or address("x://://y")[0] == ":"
    assert address("no scheme/") == address(None) == address("") == ("", "")
    assert address("http://Ünï.org?x/") == ("Ünï.org", "")


def test_index_equals_all_rules():
    index = Index(RULES, {"example": 5, "org": 9})
    for host in HOSTS:
        for path in PATHS:
            url = f"https://{host}{path}"
            assert index.judge(url) == plain(url), url


@given(st.text("aorgexmpl.:/-1es?#*% Ü", max_size=40))
def test_index_equals_all_rules_on_any_text(url):
    assert Index(RULES).judge(url) == plain(url)


def test_any_rarity_gives_the_same():
    draw = random.Random(3)
    rules = [pattern_rule(p, v) for p, v in (("||ads.*^track^", BLOCK), ("/banner/*.gif|", BLOCK), ("*pixel", BLOCK), ("|https://ok.", ALLOW), ("a*b", BLOCK))]
    words = ["ads", "track", "banner", "x.gif", "pixel", "ok", "a", "b", "/", ".", "-", "https://"]
    for _ in range(300):
        url = "https://" + "".join(draw.choice(words) + draw.choice(["", ".", "/"]) for _ in range(6))
        answers = {Index(rules, {t: draw.randrange(9) for r in rules for t in r.tokens}).judge(url) for _ in range(4)}
        every = Index(rules)
        every.everywhere, every.filed = list(range(len(rules))), {}
        assert answers == {every.judge(url)}


def test_only_fetched_rules_run():
    rules = [pattern_rule(f"||site{i}.example^") for i in range(1000)]
    index = Index(rules, {"example": 10**6})
    assert index.judge("http://www.site7.example/x")[3] == BLOCK
    assert list(index._compiled) == [7] and not index.everywhere


def test_tokens_are_whole():
    assert pattern_rule("||ads-").tokens == ("ads",)
    assert pattern_rule("ads*track.").tokens == ()
    assert address_rule("example.org", "/en/1", BLOCK).tokens == ("example", "org", "en")
    assert address_rule("example.org", "/en/", BLOCK).tokens == ("example", "org", "en")


def test_odd_rows(spark):
    long = "http://x.org/" + "a" * 100_000
    rows = [(1, None), (2, ""), (None, "http://x.org/"), (1, None), (3, "free-bets.net/x"), (4, long), (5, "http://x.net/\n?a")]
    pages = spark.createDataFrame([(*r, None, "h", 1) for r in rows], PAGES)
    got = judge_urls(pages, ADDRESSES, UNWANTED)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    assert sorted(map(str, got.collect())) == sorted(
        str(r) for r in spark.createDataFrame([(i, u, *plain(u)) for i, u in rows], got.schema).collect()
    )
    assert judge_urls(pages.limit(0), ADDRESSES, UNWANTED).count() == 0


def test_refuses_bad_rules():
    for make in (lambda: address_rule("", "/", ALLOW), lambda: address_rule("a", "b", ALLOW), lambda: pattern_rule("x", "maybe"), lambda: pattern_rule("x" * 5000), lambda: pattern_rule("x", BLOCK, "path")):
        try:
            make()
        except ValueError:
            continue
        raise AssertionError
    assert len(url_rules.UNWANTED) == 6

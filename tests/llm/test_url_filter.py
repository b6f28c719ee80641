import random

from pyspark.sql import functions as F

from dimforge.llm import url_filter
from dimforge.llm.queries import URL_RULES


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns({c: F.lit("clash") for c in ("id", "host", "path", "rule", "action", "label", "features", "prediction", "weight", "tld")})


def test_hosts_paths_and_longest_rules(spark):
    urls = {"HTTPS://WWW.Example.COM/en/x?q=1#f": ("www.example.com", "/en/x", "www.example.com/en/"), "http://m.example.com/en/5": ("m.example.com", "/en/5", "example.com/en/"),
            "http://a.com/EN/": ("a.com", "/EN/", "com/"), "http://a.com": ("a.com", "", None), "http://a.net/es/1": ("a.net", "/es/1", "net/es/"), "http://net/fr/": ("net", "/fr/", "net/fr/"),
            "http://a.net/es": ("a.net", "/es", None), "http://xnet/es/1": ("xnet", "/es/1", None), "x://y://z/": ("y:", "//z/", None), "no scheme": ("", "", None), "": ("", "", None), None: ("", "", None),
            "http://h?a/b": ("h", "", None), "http://É.com/": ("É.com", "/", "com/")}
    got = url_filter.judge_urls(pages(spark, urls), URL_RULES).collect()
    action = {r.pattern: r.action for r in URL_RULES}
    assert len(got) == len(urls)
    for r, (host, path, rule) in zip(sorted(got), urls.values()):
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block") and (rule is None or r.verdict == action[rule])


def spam(r):
    return f"http://{''.join(r.choice('0123456789xyz') for _ in range(14))}.site{r.randint(0, 9)}.{{}}/a/{r.randint(10 ** 6, 10 ** 7)}/{r.randint(10 ** 6, 10 ** 7)}?p={r.randint(0, 999)}&q={r.randint(0, 999)}&r=1"


def clean(r):
    return f"https://{r.choice(['news', 'blog', 'shop'])}.site{r.randint(0, 9)}.{{}}/{r.choice(['about', 'read', 'list'])}"


def test_trees_generalize_to_suffixes_without_rules(spark):
    r = random.Random(1)
    urls = [(spam(r).format(t), True) if r.random() < 0.5 else (clean(r).format(t), False) for t in ("com", "net") for _ in range(300)]
    rules = [url_filter.Rule("allow", "com/"), url_filter.Rule("block", "com/a/"), url_filter.Rule("allow", "blog.site1.net/")]
    got = sorted(url_filter.judge_urls(pages(spark, [u for u, _ in urls]), rules).collect())
    free = [(x.verdict == "block", bad) for x, (_, bad) in zip(got, urls) if x.rule is None]
    assert len(free) > 250 and sum(a == b for a, b in free) >= 0.9 * len(free)
    again = sorted(url_filter.judge_urls(pages(spark, [u for u, _ in urls]), rules).collect())
    assert again == got


def test_one_kind_no_labels_repeats_and_empty(spark):
    assert url_filter.judge_urls(pages(spark, ["http://a.org/"] * 3), URL_RULES).select("verdict").distinct().collect()[0][0] == "allow"
    only = url_filter.judge_urls(pages(spark, ["http://a.net/es/", "http://b.org/"]), URL_RULES).collect()
    assert {x.verdict for x in only} == {"block"}
    assert url_filter.judge_urls(pages(spark, []), URL_RULES).count() == 0


def test_no_python_on_the_executors(spark):
    r = random.Random(3)
    df = url_filter.judge_urls(pages(spark, [clean(r).format("com") for _ in range(30)] + [spam(r).format("net").replace("/a/", "/es/") for _ in range(30)]), URL_RULES)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_samples_below_the_labelled_urls_keep_both_kinds_and_the_bound(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(url_filter, "_sampled", lambda urls, most, f=url_filter._sampled: (lambda out: (sizes.append({r.label: (r["count"]) for r in out.groupBy("label").count().collect()}), out)[1])(f(urls, most)))
    urls = ["http://a.com/"] * 40 + ["http://b.net/es/"] * 40 + ["http://c.org/x"]
    got = url_filter.judge_urls(pages(spark, urls), URL_RULES, max_train_urls=1).collect()  # a bound below two URLs is one of each kind
    assert len(got) == 81 and {x.verdict for x in got if x.rule} == {"allow", "block"}
    r = random.Random(8)
    urls = ["http://hot.com/one"] * 700 + [clean(r).format("com") + f"/{k}" for k in range(900)] + [f"http://a.net/es/{k}" for k in range(7)] + ["http://long.org/" + "a1" * 100_000]
    got = url_filter.judge_urls(pages(spark, urls), URL_RULES, max_train_urls=40).collect()
    assert len(got) == len(urls) and sizes == [{0.0: 1, 1.0: 1}, {0.0: 20, 1.0: 7}]

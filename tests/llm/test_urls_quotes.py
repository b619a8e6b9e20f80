"""URL rules and templates, quotation linking, and the pipeline, on small fixtures."""

import re

from pyspark.sql import functions as F

from rasterloom.llm import quotes, url_filter
from rasterloom.llm.common import table

SF = "/root/testdata/sf0.001"


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [(h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits, key=lambda f: len(f[0])) if fits else (None, None))


URLS = [
    None, "", "no scheme", "http://", "HTTP://A.NET/x", "http://a.net", "http://net/", "http://xnet/", "http://example.net/en/1?a#b",
    "http://w.example.net/en", "http://w.example.com/de/é/1", "http://b.org/fr/x", "http://b.org/fr?/fr/", "x://y://z.net/?q", "http://É.Net/#",
    "http://h.org/" + "a/" * 3000, "http://h.org/a\nb/c", "://q.net/",
]


def test_rules_equal_loops(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, None), (None, "http://a.net/1")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit(1) for c in ("id", "host", "template", "n")})
    got = url_filter.judge(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain("http://a.net/1" if r.page_id is None else URLS[r.page_id])
        assert (r.host, r.path, r.rule) == want[:3] and r.verdict == (want[3] or "allow")
    assert url_filter.judge(pages.where("false")).collect() == []


def brute_templates(rows, labels):
    """The tree by loops over nodes, for paths of named segments and numbers."""
    label = lambda i, u: {"block": 1, "allow": 0, None: labels.get(i)}[plain(u)[3]]
    known = [(i, plain(u)[0], ["*" if re.search("[0-9]", s) else s for s in plain(u)[1].split("/") if s], label(i, u)) for i, u in rows]
    name = {i: "" for i, *_ in known}
    smooth = lambda own, above: (sum(own) + url_filter.SMOOTH * above) / (len(own) + url_filter.SMOOTH)
    purity = {i: smooth([x for _, h, _, x in known if h == host and x is not None], url_filter.PRIOR) for i, host, *_ in known}
    for level in range(max(len(s) for _, _, s, _ in known)):
        nodes = {}
        for i, host, segs, x in known:
            if len(segs) > level:
                nodes.setdefault((host, name[i]), {}).setdefault(segs[level], []).append((i, x))
        for children in nodes.values():
            total, kept = sum(map(len, children.values())), []
            for seg, members in children.items():
                if seg == "*" or len(members) < url_filter.SUPPORT or len(members) < url_filter.SHARE * total:
                    for i, _ in members:
                        name[i] += "/*"
                else:
                    own = [x for _, x in members if x is not None]
                    kept.append((sum(own) / len(own) if own else None, seg, len(own), sum(own), [i for i, _ in members]))
            for has in (True, False):
                group = []
                for child in [*sorted((k for k in kept if (k[0] is not None) == has), key=lambda k: (k[0] or 0, k[1])), None]:
                    apart = child is None
                    if group and child and has:
                        n, m, both = child[2], group[-1][2], (child[3] + group[-1][3]) / (child[2] + group[-1][2])
                        apart = child[0] - group[-1][0] > url_filter.APART * (both * (1 - both) * (1 / n + 1 / m)) ** 0.5
                    if apart:
                        first = min((g[1] for g in group), default="")
                        for g in group:
                            for i in g[4]:
                                name[i] += "/" + first + (f"|+{len(group) - 1}" if len(group) > 1 else "")
                        group = []
                    if child:
                        group.append(child)
        below = {}
        for i, host, segs, x in known:
            if len(segs) > level:
                below.setdefault((host, name[i]), []).append((i, x))
        for members in below.values():
            own = [x for _, x in members if x is not None]
            purity |= {i: smooth(own, purity[i]) for i, _ in members}
    return {i: (name[i], purity[i], plain(dict(rows)[i])[3] or ("block" if purity[i] >= url_filter.REJECT else "allow")) for i, *_ in known}


def test_templates_equal_loops(spark):
    rows, labels = [], {}
    for i in range(600):
        host = ["a.example", "b.example", "c.example.net"][i % 3]
        part = ["ads", "promo", "news", "blog", "rare" + str(i), "x"][(i // 3) % 6]
        rows.append((i, f"http://{host}/{part}/{'p' if i % 4 else 'q'}/{i}"))
        if i % 5:
            labels[i] = int(part in ("ads", "promo") or i % 40 == 1)
    pages = spark.createDataFrame(rows, "page_id long, url string")
    marks = spark.createDataFrame(list(labels.items()), "id long, blocked int")
    got = {r.page_id: (r.template, r.purity, r.verdict) for r in url_filter.judge(pages, labels=marks).collect()}
    want = brute_templates(rows, labels)
    assert {i: (t, round(p, 9), v) for i, (t, p, v) in got.items()} == {i: (t, round(p, 9), v) for i, (t, p, v) in want.items()}
    unlabelled = [v for i, (_, _, v) in want.items() if i not in labels and plain(dict(rows)[i])[3] is None]
    assert set(unlabelled) == {"allow", "block"}
    found = {t for t, _, v in want.values() if v == "block"}
    assert any(t.startswith("/ads|+1") for t in found) and any(v == "allow" for _, _, v in want.values())


def test_branches_without_labels_follow_their_parent(spark):
    rows = [(i, f"http://bad.example/ads/{'old' if i < 4 else 'new'}/{i}") for i in range(8)]
    rows += [(i, f"http://good.example/news/{'old' if i < 14 else 'new'}/{i}") for i in range(10, 18)]
    marks = [(i, 1) for i in range(4)] + [(i, 0) for i in range(10, 14)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = url_filter.judge(pages, rules=[], labels=spark.createDataFrame(marks, "id long, blocked int")).collect()
    assert {r.page_id: r.verdict for r in got} == {i: "block" if i < 8 else "allow" for i, _ in rows}
    assert {r.verdict for r in url_filter.judge(pages, rules=[]).collect()} == {"allow"}


def test_quotes(spark):
    rows = [
        (1, 0, "u", "Hello there\nHow are you?"), (1, 1, "a", "I am fine.\n> How are you?\nand you?"),
        (1, 2, "u", "X wrote:\n> I am fine.\n>> Hello there\n\n> > How are you?\nGood"), (1, 3, "a", "> nothing known\nhm"),
        (1, 4, "u", "> HELLO   there\nsecond thread"), (1, 4, "u", "> HELLO   there\nsecond thread"), (1, 5, "u", None),
        (None, 1, "u", "x"), (2, None, "u", "y"), (3, 7, None, ""),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.withColumns({c: F.lit(1) for c in ("key", "level", "hash", "conv", "source")})
    got = {(r.conv_id, r.turn): r for r in quotes.conversations(frame).collect()}
    assert len(got) == 7 and quotes.conversations(frame).count() == 7
    assert {k: (r.reply_to, r.depth, r.root) for k, r in got.items()} == {
        (1, 0): (None, 0, 0), (1, 1): (0, 1, 0), (1, 2): (1, 2, 0), (1, 3): (2, 3, 0), (1, 4): (0, 1, 0), (1, 5): (4, 2, 0), (3, 7): (None, 0, 7),
    }
    assert [got[1, t].text for t in range(6)] == ["Hello there\nHow are you?", "I am fine.\nand you?", "Good", "hm", "second thread", ""]
    assert (got[1, 2].n_quoted, got[1, 2].n_linked, got[1, 2].deepest) == (3, 3, 2) and got[1, 3].n_linked == 0
    assert quotes.conversations(frame.where("false")).collect() == []


def test_a_level_may_quote_several_messages(spark):
    rows = [
        (1, 0, "u", "one\ntwo\nthree"), (1, 1, "a", "four\nfive"), (1, 2, "u", "six"),
        (1, 3, "a", "> four\n> five\nyes\n> one\n> two\n> three\n> seven\n>> six\nno"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {(r.turn, r.level, r.source, r.lines) for r in quotes.links(quotes.lines(frame)).collect()}
    assert found == {(3, 1, 0, 3), (3, 1, 1, 2), (3, 1, None, 1), (3, 2, 2, 1)}
    last = {r.turn: r for r in quotes.conversations(frame).collect()}[3]
    assert (last.reply_to, last.n_quoted, last.n_linked, last.deepest, last.text) == (0, 7, 6, 2, "yes\nno")


def test_quotes_over_several_blocks(spark, monkeypatch):
    messages = table(spark, SF, "conversations")
    whole = {(r.conv_id, r.turn): r for r in quotes.conversations(quotes.quoting(messages)).collect()}
    monkeypatch.setattr(quotes, "TURNS", 5)
    assert {(r.conv_id, r.turn): r for r in quotes.conversations(quotes.quoting(messages)).collect()} == whole


def test_replies_depend_on_links(spark):
    rows = [(1, t, "u", f"word{t} and more of turn {t}") for t in range(12)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.turn: r for r in quotes.conversations(quotes.quoting(frame)).collect()}
    back = {t: 1 + t % 3 for t in range(12)}
    assert {t: r.reply_to for t, r in got.items() if back[t] <= t} == {t: t - back[t] for t in range(12) if 0 < back[t] <= t}
    assert got[6].links == ["1:5:2", "2:4:1"] and got[7].links == ["1:-:1", "1:3:1", "1:5:2"] and got[7].n_linked == 3
    assert [r.text for _, r in sorted(got.items())] == [r[3] for r in rows]


def test_passages_wrapped_anew(spark):
    rows = [
        (1, 0, "u", "a long line that is\nwrapped here\n\nsecond passage"), (1, 1, "a", "other"),
        (1, 2, "u", "> A long line\n> that is wrapped\n> here\nyes"), (1, 3, "a", "> wrapped here\n> wrapped there\nno"),
        (1, 4, "u", "> " + "x" * 100_000 + "\n" + "long\n" * 5_000), (1, 5, "a", ("> long\n" * 5_000)),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.turn: (r.reply_to, r.links) for r in quotes.conversations(frame).collect()}
    assert got[2] == (0, ["1:0:3"]) and got[3] == (0, ["1:-:1", "1:0:1"])
    assert got[4] == (3, ["1:-:1"]) and got[5] == (4, ["1:4:5000"])


def test_pipeline(spark):
    import corpus_pipeline
    from rasterloom.llm import bpe, decontaminate, pii, quality, simhash
    from rasterloom.llm.common import vocabulary

    docs = table(spark, SF, "documents")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    good = {r.doc_id for r in quality.score(docs, quality.train(docs, table(spark, SF, "labels"))).collect() if r.predicted}
    kept = docs.where(F.col("doc_id").isin(*good))
    kept = kept.where(F.col("doc_id").isin(*{r.component_id for r in simhash.near_duplicates(kept).collect()}))
    marks = decontaminate.contamination(kept, table(spark, SF, "benchmark")).collect()
    clean = kept.where(F.col("doc_id").isin(*{r.doc_id for r in marks if not r.contaminated}))
    want = bpe.encode_decode(pii.redact(clean), vocabulary("byte_bpe_multi_50k.tiktoken")).collect()
    assert {r.doc_id: bytes(r.ids) for r in want} == {i: bytes(r.ids) for i, r in got.items()} and 0 < len(got) < docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "pii", "bpe"]

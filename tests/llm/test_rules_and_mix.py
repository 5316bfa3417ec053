"""Quality rules, mixing, sharding, license scans and HTML extraction against brute force."""

import math
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import DOCS, WORD, awkward, clashing, empty, words
from pyspark.sql import functions as F

from docloom.llm import licenses, mix, quality, sharding, wrappers


def measured(text):
    w = words(text)
    triples = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {k for i in range(len(w) - 2) if triples[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_measures(spark, sf):
    docs = clashing(awkward(spark)).unionByName(clashing(spark.read.parquet(f"{sf}/documents.parquet")))
    got = quality.measures(docs).select("doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    for r in got:
        want = measured(r["text"])
        assert tuple(r)[2:7] == want, r["doc_id"]
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_quality_thresholds_follow_the_sketches(spark, sf, monkeypatch):
    monkeypatch.setattr(quality, "MIN_GROUP", 5)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["lang"], r["source"], measured(r["text"]), len([x for x in r["text"].split("\n") if WORD.search(x)])) for r in docs.collect()]
    values = {i: {"symbol_ratio": s / max(c, 1), "dup_line_ratio": d / max(n, 1), "repeat_ratio": p / max(w, 1), "mean_word": c / max(w, 1)}
              for i, _, _, (w, c, s, d, p), n in rows}

    base = {i: w < 50 or 100 * p > 50 * w for i, _, _, (w, _, _, _, p), _ in rows}

    def quantile(found, q):
        return found[math.ceil(q * len(found) - 1e-9) - 1]

    def binned(ids, rule):
        return sorted(math.expm1(math.ceil(math.log1p(values[i][rule] * quality.UNIT) / math.log(quality.GROWTH)) * math.log(quality.GROWTH)) / quality.UNIT for i in ids)

    groups, langs = defaultdict(list), defaultdict(list)
    for i, la, s, _, _ in rows:
        if not base[i]:
            groups[la, s].append(i)
            langs[la].append(i)
    whole = [i for i in values if not base[i]]

    def ends(rule):
        _, tolerance, _, lower = quality.RULES[rule]
        found = binned(whole, rule)
        reach = quality.REACH * (quantile(found, 0.75) - quantile(found, 0.25)) + tolerance
        return quantile(found, 0.25) - reach if lower else -1.0, quantile(found, 0.75) + reach

    def own(ids, rule):
        bottom, top = ends(rule)
        slack = quality.RULES[rule][2]
        found = [x for x in binned(ids, rule) if bottom <= x <= top]
        if not found:
            return None
        q50 = quantile(found, 0.5)
        low = -1.0 if bottom < 0 else max(bottom, q50 - quality.TAIL * (q50 - quantile(found, 0.01)) - slack)
        return low, min(top, q50 + quality.TAIL * (quantile(found, 0.99) - q50) + slack)

    def size(ids):
        return max(sum(ends(r)[0] <= x <= ends(r)[1] for x in binned(ids, r)) for r in quality.RULES)

    def fence(la, s, rule):
        now = own(whole, rule)
        for ids in (langs[la], groups[la, s]):
            mine = own(ids, rule)
            if mine:
                share = size(ids) / (size(ids) + quality.MIN_GROUP)
                now = tuple(share * m + (1 - share) * n for m, n in zip(mine, now))
        return now

    got = {r["doc_id"]: r["kept"] for r in quality.verdicts(docs).collect()}
    fences = {(la, s, r): fence(la, s, r) for la, s in groups for r in quality.RULES}
    assert len({round(high, 6) for (_, _, r), (_, high) in fences.items() if r == "mean_word"}) > 3
    for i, la, s, _, _ in rows:
        want = not base[i] and all(fences[la, s, r][0] - 1e-12 <= values[i][r] <= fences[la, s, r][1] + 1e-12 for r in quality.RULES)
        assert got[i] == want, i
    kept = quality.keep_good(docs)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, k in got.items() if k} and kept.columns == docs.columns


def test_sketches_merge(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    values = quality.rule_values(quality.measures(docs))
    bins = quality.sketches(values)
    total = bins.groupBy("level", "rule").agg(F.sum("n").alias("n")).collect()
    assert {r["n"] for r in total} == {docs.count()} and len(total) == 3 * len(quality.RULES)


def test_quality_keeps_uniform_clean_documents(spark):
    draw = random.Random(2)
    rows = [(i, " ".join(f"word{draw.randrange(5000)}" for _ in range(80)), "en", "s", 0) for i in range(300)]
    rows += [(900, " ".join(f"a{i}$$$###" for i in range(80)), "en", "s", 0)]
    got = {r["doc_id"]: r["kept"] for r in quality.verdicts(spark.createDataFrame(rows, DOCS)).collect()}
    assert not got.pop(900) and all(got.values())


def test_junk_does_not_raise_its_own_fence(spark):
    """Of two sources one holds 30 % junk, symbols in every word: it loses that, the other source nothing."""
    draw = random.Random(3)
    prose = lambda: " ".join("w" + "abcdefgh"[:draw.randrange(2, 8)] + str(draw.randrange(3000)) for _ in range(90))
    rows = [(i, prose(), "en", "clean" if i % 2 else "mixed", 0) for i in range(1700)]
    junk = [(5000 + i, " ".join(f"a{draw.randrange(900)}$$" for _ in range(90)), "en", "mixed", 0) for i in range(360)]
    got = {r["doc_id"]: r["kept"] for r in quality.verdicts(spark.createDataFrame(rows + junk, DOCS)).collect()}
    assert not any(got[i] for i, *_ in junk)
    assert sum(not got[i] for i, *_ in rows) == 0


def test_quality_awkward(spark):
    rows = clashing(awkward(spark))
    assert quality.verdicts(rows).count() == rows.count()
    kept = quality.keep_good(rows)
    assert kept.columns == rows.columns and {r["doc_id"] for r in kept.collect()} >= {7, 8, 18}
    assert quality.verdicts(empty(spark)).count() == quality.keep_good(empty(spark)).count() == 0


def brute_targets(sizes):
    """Weights by code point, null last; share of 150 %; limit of 2 times the size, excess reshared until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mix.WEIGHTS[k % 3] for k, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free} | {s: 2.0 * sizes[s] for s in full}
        over = {s for s in free if target[s] > 2 * sizes[s]}
        if not over:
            return target
        full |= over


def test_mix(spark, sf):
    docs = clashing(awkward(spark)).unionByName(clashing(spark.read.parquet(f"{sf}/documents.parquet").withColumn("doc_id", F.col("doc_id") + 100)))
    got = mix.mix(docs).collect()
    sizes, taken = Counter(), Counter()
    for r in docs.collect():
        sizes[r["source"]] += len(words(r["text"]))
    want = brute_targets(sizes)
    assert len(got) == docs.count()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], want[r["source"]], rel_tol=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= mix.BLOCK_WORDS for s in sizes)
    key = lambda rows: sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in rows)
    assert key(got) == key(mix.mix(docs.repartition(5)).collect())
    assert mix.mix(empty(spark)).count() == 0
    texts = mix.mixed_documents(docs)
    assert texts.columns == docs.columns
    per = Counter()
    for r in texts.collect():
        per[r["source"]] += len(words(r["text"]))
    assert per == +taken
    assert mix.mixed_documents(empty(spark)).count() == 0


def test_sainte_lague_deals_the_highest_quotients(spark):
    draw = random.Random(9)
    rows = [(g, k, float(draw.choice([0, 1, 5, 5, 17, 900, 4321])), s) for g, s in enumerate([0, 1, 3, 10, 57, 1000]) for k in range(12)]
    df = spark.createDataFrame(rows, "g int, k int, votes double, seats long")
    got = {(r["g"], r["k"]): r["won"] for r in mix.apportion(df, ["g"], "votes", "seats", "won", ["k"]).collect()}
    for g in range(6):
        cells = [r for r in rows if r[0] == g]
        seats, won = cells[0][3], Counter()
        for _ in range(seats):
            best = max(cells, key=lambda r: (r[2] / (2 * won[r[1]] + 1), -r[1]))
            if best[2] > 0:
                won[best[1]] += 1
        assert {r[1]: won[r[1]] for r in cells} == {r[1]: got[g, r[1]] for r in cells}


def check_shards(docs, rows, shards=sharding.SHARDS):
    counts = Counter(r["shard"] for r in rows)
    assert len(rows) == docs.count() and max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in rows)


def test_sharding(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sharding.balanced_shards(docs).collect()
    check_shards(docs, rows)
    where = defaultdict(set)
    for r in rows:
        where[r["text_crc32"]].add(r["shard"])
    assert sum(len(v) > 1 for v in where.values()) <= 1


def test_sharding_hot_group_and_awkward(spark):
    hot = spark.range(1200).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
    rows = sharding.balanced_shards(hot).collect()
    check_shards(hot, rows)
    copies = Counter(r["shard"] for r in rows if r["text_crc32"] == zlib.crc32(b"same"))
    assert sum(n * n for n in copies.values()) > 2 * 400 * 400 / 24  # pairs side by side, against an even spread
    docs = clashing(awkward(spark))
    check_shards(docs, sharding.balanced_shards(docs).collect())
    assert sharding.balanced_shards(empty(spark)).count() == 0


@pytest.mark.parametrize("copies", [2, 5])
def test_sharding_keeps_groups_whole_where_every_row_is_linked(spark, copies):
    docs = spark.range(9600).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % (9600 // copies)).cast("string")).alias("text"))
    rows = sharding.balanced_shards(docs).collect()
    check_shards(docs, rows)
    where = defaultdict(set)
    for r in rows:
        where[r["text_crc32"]].add(r["shard"])
    assert sum(len(v) == 1 for v in where.values()) >= 0.95 * len(where)


LICENSE_LINES = ["Licensed under CC BY 4.0, all RIGHTS reserved", "this work is licensed under the GNU general public license version 3",
                 "Released under the MIT License.", "MIT License the under Released", "cc", "cc by cc by", "all rights\nreserved", "ALL-RIGHTS-RESERVED"]


def license_rows(spark, sf):
    rows = [(r["doc_id"] + 100, r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows += [(10_000 + k, f"{t}\nx y {u}") for k, (t, u) in enumerate((t, u) for t in LICENSE_LINES for u in LICENSE_LINES)]
    longest = max((t for texts in licenses.TEMPLATES.values() for t in texts), key=len)
    words = longest.split()
    rows += [(20_000 + 2 * k + n // 40, " ".join(words[:k] + ["other"] * n + words[k:])) for k in range(0, len(words), 9) for n in (1, 40)]
    rows += [(30_000 + k, " ".join(words[k:] + words[:k])) for k in range(0, len(words), 13)]
    return rows


def test_licenses(spark, sf):
    docs = clashing(spark.createDataFrame(license_rows(spark, sf), "doc_id long, text string")).unionByName(clashing(awkward(spark).select("doc_id", "text")))
    got = licenses.scan(docs).collect()
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r["doc_id"]].append(r["text"])
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    known = [(label, pattern.findall(low(t))) for label, ts in sorted(licenses.TEMPLATES.items()) for t in ts]
    assert len(got) == docs.count()
    for r in got:
        w = pattern.findall(low(texts[r["doc_id"]][0] or ""))
        at = lambda p: [i for i in range(len(w)) if w[i:i + len(p)] == p]
        places = [(i, label) for p, label in licenses.PHRASES.items() for i in at(p.split())]
        found = []
        for label, t in known:
            tokens = set(t)
            if len(t) < 8:
                found += [(label, 1.0)] if at(t) else []
            elif len(tokens & set(w)) >= 0.9 * len(tokens) - 1e-9:
                most = max(len(tokens & set(w[i:i + len(t)])) for i in range(len(w)))
                found += [(label, most / len(tokens))] if most >= 0.9 * len(tokens) - 1e-9 else []
        starts, base = [i for i, _ in places], {label for _, label in places}
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(w), len(starts), min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted(base)) and r["labels"] == ",".join(sorted(base | {b[0] for b in found}))
        assert r["score"] == (1.0 if base else max([0.0, *(b[1] for b in found)]))
        assert sorted((b["label"], b["containment"]) for b in r["blocks"]) == sorted(found)
    assert licenses.scan(empty(spark)).count() == 0


@pytest.mark.parametrize("width", [20, 40, 72, 10_000])
def test_wrapped_notices_are_found(spark, width):
    """Every template, wrapped and behind comment marks, inside other text."""
    rows = []
    for label, texts in licenses.TEMPLATES.items():
        for t in texts:
            lines = "\n".join(f" * {line}" for line in textwrap.wrap(t, width))
            rows.append((len(rows), f"some code here\n/*\n{lines}\n */\nint main", label))
    got = {r["doc_id"]: r["labels"].split(",") for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, label string")).collect()}
    assert all(label in got[i] for i, _, label in rows)


def test_scattered_words_are_no_license(spark):
    rows = [(1, "all the rights are reserved for all who have reserved seats"), (2, "the licensed version 2 of apache was under the old license 0"),
            (3, "by 4 of them nc cc 0 under licensed")]
    assert [r["labels"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()] == ["", "", ""]


def page(title, paragraphs, extra=""):
    return (f"<html><head><title>{title}</title><style>p{{}}</style></head><body><header>Site</header><nav><a href='/'>Home</a></nav>"
            f"<div id='top-ad-3' class=ad>Buy {title}</div><div class='content'><h1>{title}</h1>{''.join(f'<p>{p}' for p in paragraphs)}</div>"
            f"<div class='note'>All pages are the same here</div>{extra}<aside>More</aside><footer>&copy; x</footer></body></html>")


def test_wrappers_find_the_varying_part(spark):
    rows = [(k, "http://h.example/p", page(f"Title {k}", [f"first &amp; {k}  <b>bold</b>text", f"second\n {k}"])) for k in range(5)]
    rows += [(9, "http://h.example/q", None), (10, None, "<p>only<script>var x = '</p>';</script> one<!-- no --></p>"), (11, "odd url", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("text", F.lit("x"))
    got = {r["page_id"]: r for r in wrappers.extract(df).collect()}
    for k in range(5):
        assert got[k]["text"] == f"Title {k}\nfirst & {k} boldtext\nsecond {k}" and got[k]["n_chars"] == len(got[k]["text"])
    assert (got[9]["text"], got[10]["text"], got[11]["text"], got[11]["n_chars"]) == ("", "only one", "", 0)
    assert wrappers.extract(df.limit(0)).count() == 0


def test_landmarks_decide_on_a_single_page():
    text = wrappers.main_text("<body><nav>menu</nav><main><article><header><h1>T</h1></header><p>a<br>b<div class='share-bar'>x</div><form>f</form>"
                              "<section class='comments'><article>c</article></section></article></main><div class='cookie-notice'>n</div>", None)
    assert text == "T\na\nb"


def test_equal_articles_are_no_template():
    same = "<article><h1>T</h1><p>body</p></article>"
    pages = [f"<html><body><div>nav {k}</div>{same}</body></html>" for k in range(3)]
    spec = wrappers.induce(pages)
    assert all(wrappers.main_text(p, spec) == "T\nbody" for p in pages)


def extracted(spark, htmls):
    rows = [(k, f"http://h.example/{k}", h) for k, h in enumerate(htmls)]
    return [r["text"] for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()]


def test_all_pages_of_a_host_vote_and_layouts_stay_apart(spark):
    teasers = "<div class='list'><p>Teaser {0} a</p><p>Teaser {0} b</p></div>"
    lists = [f"<body><div>All stories</div>{teasers.format(k)}</body>" for k in range(12)]
    articles = [f"<body><div class='list'><p>More {k}</p></div><article><h1>Title {k}</h1><p>Body {k}</p></article></body>" for k in range(4)]
    plain = [f"<body><div>Our site</div><div class='story'><p>Tale {k}</p><p>{'Same start' if k < 2 else f'Start {k}'}</p></div><div>Write to us</div></body>" for k in range(6)]
    got = extracted(spark, lists + articles + plain)
    assert got[:12] == [f"Teaser {k} a\nTeaser {k} b" for k in range(12)]
    assert got[12:16] == [f"Title {k}\nBody {k}" for k in range(4)]
    assert got[16:] == [f"Tale {k}\n{'Same start' if k < 2 else f'Start {k}'}" for k in range(6)]


def test_template_texts_inside_articles_are_left_out(spark):
    body = lambda k: f"<article><h1>Title {k}</h1><p>{f'Body {k} of the story. ' * 6}</p><p>Subscribe to our newsletter</p></article>"
    pages = [f"<body><div>nav {k}</div>{body(k % 6)}</body>" for k in range(20)]
    for k, text in enumerate(extracted(spark, pages)):
        assert text == f"Title {k % 6}\n{(f'Body {k % 6} of the story. ' * 6).strip()}"
    near = [f"<body><article><p>{'One long story told again and again. ' * 9}</p><p>Version {k}</p></article></body>" for k in range(8)]
    assert all(t.endswith(f"again.\nVersion {k}") for k, t in enumerate(extracted(spark, near)))
    assert [wrappers.main_text(p, wrappers.induce(pages)) for p in pages] == extracted(spark, pages)


NOTE = "<p>Subscribe for daily mail</p>"


@pytest.mark.parametrize("make", [
    lambda k, body: f"<div class='entry' id='story-{'xyzuvw'[k % 6]}'>{body}{NOTE}</div>",  # a slug of its own
    lambda k, body: f"<div class='entry'>{'<div class=lead>Extra ' + str(k) + '</div>' if k % 3 == 0 else ''}{body}{NOTE}</div>",  # one block more on some pages
    lambda k, body: f"<div class='entry'>{''.join(f'<p>item {k} {j}</p>' for j in range(k % 5))}{body}{NOTE}</div>",  # a list of varying length
    lambda k, body: "<div class='entry'>" + "".join([[body, NOTE], [NOTE, body]][k % 2]) + "</div>",  # another order
    lambda k, body: f"<div class='entry'><div class='box'>{body}</div><div class='wrap'>{NOTE}</div></div>" if k % 4 else
                    f"<div class='entry'><ul><li>x {k}</ul><div class='box'>{body}</div><div class='wrap'>{NOTE}</div></div>",
])
def test_templates_are_found_by_alignment(spark, make):
    pages = [f"<html><body>{make(k, f'<p>Story {k} tells one thing</p><p>and {k} another</p>')}</body></html>" for k in range(12)]
    got = extracted(spark, pages)
    assert all("Subscribe" not in t and f"Story {k} tells one thing\nand {k} another" in t for k, t in enumerate(got))
    assert got == [wrappers.main_text(p, wrappers.induce(pages)) for p in pages]


def test_repeated_rows_and_long_pages(spark):
    long = "<article>" + "".join(f"<p>part {j} <b>of</b> a long page</p><ul><li>{j}</ul>" for j in range(4000)) + "</article>"
    rows = [(1, "http://a/x", "<article><p>one</p></article>"), (1, "http://a/x", "<article><p>one</p></article>"), (2, "http://a/y", long), (2, "http://a/z", long.replace("part 7 ", "piece 7 "))]
    got = wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r["page_id"], len(r["text"].split("\n"))) for r in got) == [(1, 1), (1, 1), (2, 8000), (2, 8000)]


def test_matching_equals_the_plain_recursion():
    def plain(a, b):
        if a.step != b.step:
            return 0
        left, right = a.nodes(), b.nodes()
        best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
        for i in range(len(left)):
            for j in range(len(right)):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + plain(left[i], right[j]))
        return best[-1][-1] + 1

    draw = random.Random(6)

    def tree(depth):
        return "".join(f"<{t}>{tree(depth - 1) if depth else 'x'}</{t}>" for t in (draw.choice(["div", "section", "ul"]) for _ in range(draw.randrange(4))))

    for _ in range(60):
        a, b = wrappers.parse(f"<div>{tree(3)}</div>"), wrappers.parse(f"<div>{tree(3)}</div>")
        size, pairs = wrappers.match(a, b)
        assert size == plain(a, b) == len(pairs) and all(x.step == y.step for x, y in pairs)
        assert len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == size


def test_tree_matching_counts_the_largest_mapping():
    a, b = wrappers.parse("<ul><li>1<li>2<li>3</ul><p>x"), wrappers.parse("<ul><li>1<li>3</ul><div></div><p>y")
    size, pairs = wrappers.match(a, b)
    assert size == 5 and {(x.tag, y.tag) for x, y in pairs} == {("#root", "#root"), ("ul", "ul"), ("li", "li"), ("p", "p")}


def test_long_lists_have_the_largest_mapping(monkeypatch):
    # first fit takes the last section for the first and leaves out all 300 between; the table of 90,000 pairs is more than CELLS
    a, b = wrappers.parse("<section></section>" + "<div>x</div>" * 300), wrappers.parse("<ul><li>1</ul>" + "<div><p>x</div>" * 300 + "<section><p>1</section>")
    size, pairs = wrappers.match(a, b)
    assert size == len(pairs) == 301 and sum(x.tag == "div" for x, _ in pairs) == 300

    draw = random.Random(3)
    inner = ["<p>x</p>", "<b>x</b>", "<p>x</p><b>x</b>", "<ul><li>x</ul>", ""]
    for table, known in ((1 << 21, 500_000), (40, 7), (1, 0)):
        for _ in range(15):
            a, b = (wrappers.parse("".join(f"<{t}>{draw.choice(inner)}</{t}>" for t in draw.choices(["div", "section", "h2"], k=draw.randrange(30)))) for _ in range(2))
            monkeypatch.setattr(wrappers, "CELLS", 40_000)
            want = [(x.number, y.number) for x, y in wrappers.match(a, b)[1]]
            for name, value in (("CELLS", 0), ("TABLE", table), ("KNOWN", known)):
                monkeypatch.setattr(wrappers, name, value)
            assert [(x.number, y.number) for x, y in wrappers.match(a, b)[1]] == want


@pytest.mark.parametrize("html", ["<", "<<p>a</", "</p></p>", "<p class='x", "&#x110000;&bogus;", "<script>never closed", "<p" * 3000])
def test_broken_pages_do_not_crash(html):
    assert isinstance(wrappers.main_text(html, None), str)


def test_mixed_documents_write_ids_and_sizes_only(spark):
    from pathlib import Path
    from docloom.session import shared_folder
    written = lambda: {p: p.stat().st_size for p in Path(shared_folder(spark)).rglob("mix-*/*.parquet")}
    draw = random.Random(4)
    rows = [(i, " ".join(f"{draw.getrandbits(60):x}" for _ in range(200)), f"s{i % 2}") for i in range(300)]
    # 40 rows of one id and size, which a cut can go through
    rows += [(-1, " ".join(f"{draw.getrandbits(60):x}" for _ in range(50)), "twins") for _ in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    before = written()
    got = mix.mixed_documents(docs).collect()
    new = sum(size for p, size in written().items() if p not in before)
    assert new < sum(len(r[1]) for r in rows) / 10
    per, want = Counter(), Counter()
    for r in got:
        per[r["source"]] += len(words(r["text"]))
    for r in mix.mix(docs).collect():
        want[r["source"]] += r["taken"]
    assert per == want
    assert max(Counter(r["text"] for r in got).values()) <= 2

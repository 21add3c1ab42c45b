"""Pages labelled by hand, training's bound, and columns that the pipeline must leave alone."""

import ipaddress
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_pages_vectors import _near_corpus

from benchlake.llm import html_text, pii, suffix_dedup, toxicity

LONG = "The council met on Tuesday to discuss the budget for the coming year, and after a long debate the members agreed to raise it by two percent. Nobody was surprised."
#: Names of subjects that hold a word of page furniture.
SUBJECTS = "share-price search-history social-reform privacy-law form-of-government comment-on-law related-work promotion-rules trending-topics banner-year cookie-recipe menu-of-the-day footer-fetish warning-signs login-history message-theory".split()
#: Names of furniture, which stays out wherever it stands.
FURNITURE = "ad ads ad-slot advert comments comment-list related-posts related-links share share-buttons social-links newsletter newsletter-signup promo cookie-banner sidebar nav site-nav menu pagination breadcrumb popup modal subscribe-box sponsored footer site-footer login-form".split()

#: (page, its text): [..] marks what is content, block by block.
PAGES = [
    f"<body><header><h1>Site</h1><nav><a href=/>Home</a></nav></header><article><h1>[A title]</h1><p>[{LONG}]</p><ul><li>[First point]</li><li>[Second point]</li></ul></article><footer>Copyright by us.</footer></body>",
    f"<body><div id=content><h1>[A headline of the day]</h1><p>[{LONG}]</p><p>[{LONG}]</p></div><div id=sidebar><h3>More</h3><p>{LONG}</p></div><div class=footer><p>All rights reserved. Contact us for more.</p></div></body>",
    f"<article><h2>[References]</h2><p>[{LONG}]</p><ol><li><a href=a>[Smith, On budgets, 2019]</a></li><li><a href=b>[Jones, Councils, 2020]</a></li><li><a href=c>[Brown, Taxes]</a></li></ol><p>[{LONG}]</p></article>",
    f"<article><p>[{LONG}]</p><ul><li><a href=a>[Linked]</a></li><li><a href=b>[Words]</a></li></ul></article><div class='related-posts'><ul><li><a href=c>Another story altogether</a></li></ul></div>",
    f"<main><h1>[Minutes]</h1><table><tr><td>[Year]</td><td>[Budget]</td></tr><tr><td>[2024]</td><td>[7]</td></tr></table><p>[{LONG}]</p></main><form><p>Sign up for our letters, they are good. Really good ones, every day.</p><label>Name</label></form>",
    f"<article><p>[{LONG}]</p><blockquote><p>[A short quote.]</p></blockquote><pre>[code = 1]</pre><div class=comments><p>{LONG}</p><p>Me too.</p></div></article>",
    f"<body><div class='post-content'><p>[{LONG}]</p><h2>[Next]</h2><p>[Short.]</p><p>[{LONG}]</p></div><div class='comments'><div class='comment'><p>{LONG}</p></div></div></body>",
    f"<article><header><h1>[Title]</h1></header><section><h2>[One]</h2><p>[{LONG}]</p></section><section><h2>[Two]</h2><p>[{LONG}]</p></section><footer><p>Filed under news.</p></footer></article>",
    "<nav><ul><li><a href=a>A</a></li></ul></nav><div class=notice><p>We use cookies on this site. Please accept all of them.</p></div>",
    *(f"<body><nav><a href=a>A</a></nav><article><h1>[Heading]</h1><div class='{x}'>[{LONG}]</div><p>[{LONG}]</p></article></body>" for x in SUBJECTS),
    *(f"<article><div class='{x} wide'><p>[{LONG}]</p></div><p>[End of it.]</p></article>" for x in SUBJECTS),
    *(f"<body><article><h1>[Heading]</h1><p>[{LONG}]</p><div class='{x}'><p>{LONG}</p></div><p>[{LONG}]</p></article><div id='{x}'>{LONG}</div></body>" for x in FURNITURE),
]


def test_pages_labelled_by_hand():
    kept = right = content = 0
    wrong = []
    for page in PAGES:
        want = re.findall(r"\[(.*?)\]", page)
        text = html_text.main_text(re.sub(r"[\[\]]", "", page))
        got = text.split("\n\n") if text else []
        own = sum(min(want.count(x), got.count(x)) for x in set(want))
        kept, right, content = kept + len(got), right + own, content + len(want)
        if got != want:
            wrong.append((page[:90], got))
    assert right / kept == 1 and right / content == 1, wrong


@pytest.mark.parametrize("page", ["<i>" * 20_000 + "a<p>b</p>" * 20_000, "<article>" + "<b><i>" * 20_000 + "x<div>y</div>" * 20_000, "<a class=x>" * 20_000 + "a<br><p>b" * 20_000])
def test_deep_inline_elements_take_linear_time(page):
    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 8


def test_training_takes_one_text_of_a_repeated_label(spark, monkeypatch):
    """A labelled doc_id that repeats brings one row to the training task, and any order of rows brings the same."""
    seen = []
    own = toxicity.Ftrl.learn

    def learn(self, x, y):
        seen.append(len(x))
        own(self, x, y)

    monkeypatch.setattr(toxicity.Ftrl, "learn", learn)
    ids = [k for k in range(1, 40) if __import__("zlib").crc32(str(k).encode()) % 5]
    rows = [(ids[0], f"hot words {k}") for k in range(3000)] + [(k, f"text of {k}") for k in ids[1:]]
    labels = spark.createDataFrame([(k, int(k % 2)) for k in ids], "doc_id long, toxic int")
    models = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        models.append(toxicity.train(docs, labels))
        chosen = toxicity.texts(docs).join(labels, "doc_id").groupBy("doc_id").count().filter("count > 1").count()
        assert chosen == 1
    assert models[0] == models[1]


@pytest.mark.parametrize("bound", [1, 7, 20])
def test_the_bound_takes_the_smallest_hashes(spark, bound):
    """Fewer labels than there are: the same ones as a whole sort would take."""
    ids = [k for k in range(300) if __import__("zlib").crc32(str(k).encode()) % 5]
    docs = spark.createDataFrame([(k, f"w{k} v{k}") for k in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1) for k in ids], "doc_id long, toxic int")
    first = [r.k for r in spark.createDataFrame([(k,) for k in ids], "k long").orderBy(F.xxhash64("k"), "k").limit(bound).collect()]
    want = toxicity.train(docs.filter(F.col("doc_id").isin(first)), labels.filter(F.col("doc_id").isin(first)))
    assert toxicity.train(docs, labels, max_labelled=bound) == want


def test_pipeline_leaves_columns_of_any_name_alone(spark):
    import corpus_pipeline as p

    rng = random.Random(4)
    texts = [*_near_corpus(rng, 8), "", None, "same text", "same  text"]
    names = ["_id", "_row", "row", "kept", "node", "kept_id", "KEPT_ROW", "row_hash", "component_id", "doc_id_", "score", "group"]
    rows = [(k, t, "en", "s", len(t or ""), *(1000 * j + k for j in range(len(names)))) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` long" for n in names)).repartition(3)
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    sf = "/root/testdata/sf0.001"
    for name, stage in p.STAGES[:-1]:
        out = p.materialize(stage(spark, docs, sf), name)
        bare = p.materialize(stage(spark, plain, sf), name)
        assert out.columns == docs.columns
        got = out.collect()
        assert all(r[n] == 1000 * j + r.doc_id for r in got for j, n in enumerate(names))
        assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in bare.collect())
        docs, plain = out, bare


def test_null_and_empty_twins_of_one_id_are_one_document(spark):
    import corpus_pipeline as p

    rows = [(1, None), (1, ""), (1, ""), (2, "x y"), (2, "xy"), (3, None), (None, ""), (None, None)]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    out = p.drop_copies(spark, docs, "").collect()
    assert len(out) == 2 and {(r.doc_id, r.text or "") for r in out} in ({(None, ""), (2, "x y")}, {(1, ""), (2, "x y")})


KEY = b"a key"


@pytest.mark.parametrize(
    ("text", "entity"),
    [
        ("Ask DR JOHN SMITH now", "DR JOHN SMITH"), ("Ask MRS. ANNA O'NEILL.", "MRS. ANNA O'NEILL"), ("Mr. O’Neill came", "Mr. O’Neill"), ("Mr Smith's car", "Mr Smith"), ("Ms D’Angelo-Kraus’s car", "Ms D’Angelo-Kraus"), ("Dr Anna Weber", "Dr Anna Weber"),
        ("Herr Jürgen Groß sagt", "Herr Jürgen Groß"), ("mail ß@test.com", "ß@test.com"), ("ping 2001:db8::7 twice", "2001:db8::7"),
    ],
)
def test_names_in_capitals_and_with_apostrophes(text, entity):
    (found,) = pii.detect(text)
    assert text[found[0] : found[1]] == entity
    new = pii.surrogate(found[2], entity, KEY)
    assert new != entity and pii._made(found[2], new, KEY, True) == entity and len(new.split()) == len(entity.split())


def test_coreference_and_gender_do_not_depend_on_case():
    for given in ("John", "Anna", "Zork"):
        one, two = pii.surrogate("name", f"Dr {given} Smith", KEY), pii.surrogate("name", f"DR {given.upper()} SMITH", KEY)
        assert one.upper() == two.upper() and two == two.upper()
        assert pii.surrogate("name", f"Dr {given} SMITH", KEY).upper() == two
    assert pii.surrogate("name", "MR JOHN SMITH", KEY).split()[1].capitalize() in pii.NAMES["m", "latin"]
    assert pii.surrogate("name", "FRAU ANNA SMITH", KEY).split()[1].capitalize() in pii.NAMES["f", "latin"]
    rng = random.Random(6)
    given = [*pii.NAMES["m", "latin"], *pii.NAMES["f", "latin"], *("".join(rng.choices("aeiouklmnrst", k=5)).capitalize() for _ in range(200))]
    names = sorted({f"{t} {g}" for t in ("Dr", "Mr", "DR", "MR") for n in given for g in (n, n.upper())})
    assert len({pii.surrogate("name", n, KEY) for n in names}) == len(names)


def test_addresses_stay_in_their_class():
    for text in ("::1", "::", "at ::1 now"):
        assert pii.detect(text) == []
    rng = random.Random(7)
    for prefix, bits in [("::ffff:0:0", 96), ("64:ff9b::", 96), ("2001:db8::", 32), ("fe80::", 16), ("2001::", 16), ("::", 16), ("fd00::", 16)]:
        olds = {str(ipaddress.IPv6Address(int(ipaddress.IPv6Address(prefix)) | rng.getrandbits(min(40, 128 - bits)) + 2)) for _ in range(300)}
        news = {pii.surrogate("ipv6", o, KEY) for o in olds}
        assert len(news) == len(olds) and all(pii._ipv6_class(int(ipaddress.IPv6Address(n))) == pii._ipv6_class(int(ipaddress.IPv6Address(prefix)) + 2) for n in news)


def test_grams_that_share_a_hash_alone_are_told_apart():
    """Two grams under one hash: suffixes of either would lie between those of the other if their first bytes were skipped."""
    rng = random.Random(9)
    for _ in range(20):
        one, two = (bytes(rng.randrange(256) for _ in range(suffix_dedup.GRAM)) for _ in range(2))
        tails = [bytes(rng.choices(b"ab", k=68)) for _ in range(6)]
        right = [g + t for g in (one, two) for t in tails for _ in range(2)]
        rng.shuffle(right)
        left = [b"x" * 68] * len(right)
        most, _ = suffix_dedup.repeated(np.zeros(len(right), np.int64), left, right)
        want = [suffix_dedup.REACH if any(right[j][:32] == right[k][:32] for j in range(k)) else -1 for k in range(len(right))]
        assert [(m >= 0) for m in most] == [w >= 0 for w in want]
        first = [max((a for a in range(suffix_dedup.REACH + 1) if any(r[: 100 - a] == right[k][: 100 - a] for r in right[:k])), default=-1) for k in range(len(right))]
        assert most.tolist() == first
    assert suffix_dedup.same_grams(np.array([0, 0, 1, 1, 2]), [b"a" * 40, b"a" * 40, b"b" * 40, b"c" * 40, b"d" * 10]).tolist() == [True, True, False, False, False]

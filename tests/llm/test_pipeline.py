"""The whole pipeline against stages in plain Python on a small corpus."""

import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_documents import check_sequences, slow_best_fit, slow_features, slow_ftrl
from test_pages_vectors import _near_corpus, _slow_groups
from tokenizers import Tokenizer

from benchlake.llm import packing, pii, toxicity


def slow_pipeline(rows, labels, order):
    """(doc_id, text) of what the first four stages keep, in plain Python."""
    bits = toxicity.BITS
    text = dict(rows)
    learnt = sorted((k for k in labels if zlib.crc32(str(k).encode()) % 5), key=lambda k: order[k])
    w = slow_ftrl([(sorted(slow_features(text[k] or "", bits) | {1 << bits}), labels[k]) for k in learnt], bits, toxicity.EPOCHS)
    toxic = lambda t: 1 / (1 + np.exp(-(sum(w.get(i, 0.0) for i in slow_features(t or "", bits)) + w[1 << bits]))) >= 0.5
    rows = [(k, t) for k, t in rows if not toxic(t)]
    best = {}
    for k, t in rows:
        n = "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
        best[n] = min(best.get(n, (1, 0)), (-len(t or ""), k))
    stay = {k for _, k in best.values()}
    rows = [(k, t) for k, t in rows if k in stay]
    groups, _ = _slow_groups([(k, t or "") for k, t in rows])
    rows = [(k, t) for k, t in rows if groups[k] == k]
    return [(k, None if t is None else pii.rewrite(t, pii.TRIAL_KEY.encode())[0]) for k, t in rows]


def test_run_equals_plain_python(spark, tmp_path):
    import corpus_pipeline as p

    rng = random.Random(31)
    texts = _near_corpus(rng, 25)
    texts += ["", None, " \n", "Mail a.b@example.com or +49 30 123 4455, Mr Paul Weber.", "card 4785380592391139", *(t + " " for t in rng.sample(texts, 12)), " ".join(rng.choices(["alpha", "beta", "gamma"], k=5000))]
    bad = [f"{' '.join(rng.choices(['w1', 'w2', 'w3', 'w9'], k=rng.randint(5, 30)))} scum {' '.join(rng.choices(['w5', 'w6'], k=5))}" for _ in range(60)]
    texts += bad
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    labels = {k: int("scum" in (t or "")) for k, t in rows if rng.random() < 0.8}
    spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, y) for k, y in labels.items()], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    order = {r.k: r.o for r in spark.createDataFrame([(k,) for k, _ in rows], "k long").select("k", F.xxhash64("k").alias("o")).collect()}
    kept = slow_pipeline(rows, labels, order)
    assert 20 < len(kept) < len(rows) - 60 - 12
    t = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = []
    for k, text in kept:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, packing.SEPARATOR], "<u4")
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        want += [(k, i, a, z - a, zlib.crc32(ids[a:z].tobytes())) for i, (a, z) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
    got = p.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    assert check_sequences([(r.sequence_id, r.offset, r.length) for r in got], 1024) <= slow_best_fit([r[3] for r in want], 1024) * 1.01 + 1

"""Quality rules (7), classifiers (3, 4, 5): plain recomputation of what is exact, held-out accuracy of what is learned."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np

from regioncast.llm import doc_stats, langid, quality, queries, rules, toxicity
from tests.llm.helpers import HARD, SF, documents, sf_rows

CHECK = "/root/testdata/sf0.01"


def labels_of(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def crc(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


# Quality rules


def brute_stats(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    counts, cover = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            cover.update(range(i, i + 5))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover)


def test_stats_equal_plain_counts():
    texts = [t for _, t in sf_rows()] + [t for _, t in HARD] + ["a b c d e f a b c d e", "x " * 9, "1 2 3 4 5 1 2 3 4"]
    for t in texts:
        s = dict(zip(doc_stats.STATS, doc_stats.text_stats(None if t is None else t.encode())))
        assert (s["n_words"], s["word_chars"], s["n_symbols"], s["n_dup_lines"], s["n_repeat_words"]) == brute_stats(t)


def test_op7_whole_table(spark):
    got = {r.doc_id: r for r in queries.op7_mcd_rules(spark, SF).collect()}
    rows = sf_rows()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        r, s = got[doc_id], brute_stats(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == s
        assert r.base_failed == (s[0] < 10 or 100 * s[4] > 20 * s[0]) and not (r.base_failed and r.kept)


def test_rules_keep_good_texts_and_reject_junk(spark):
    from regioncast.llm.common import table

    got = rules.quality_rules(table(spark, CHECK, "documents")).select("doc_id", "base_failed", "kept").toPandas()
    m = got.merge(duckdb.sql(f"select doc_id, quality from '{CHECK}/labels.parquet'").df(), on="doc_id")
    m = m[~m.base_failed]
    assert m[m.quality == 1].kept.mean() > 0.98 and m[m.quality == 0].kept.mean() < 0.3


def test_rules_hard_cases(spark):
    docs = documents(spark, [(*r, None, "s") for r in HARD])
    rows = rules.quality_rules(docs).collect()
    assert len(rows) == len(HARD) and all(r.kept == (not r.base_failed) for r in rows)  # no row is left for an estimate
    alone = documents(spark, [(1, "ten plain words of a text that is all alone here", "xx", None)])
    assert [r.kept for r in rules.quality_rules(alone).collect()] == [True]
    assert rules.quality_rules(docs.limit(0)).collect() == []


def test_mcd_estimate_ignores_outliers(spark):
    rng = np.random.default_rng(8)
    good, bad = rng.normal(0, 1, (900, rules.D)), rng.normal(25, 0.5, (200, rules.D))
    rows = [("a", "b", *map(float, x)) for x in np.vstack([good, bad])]
    df = spark.createDataFrame(rows, "lang_key string, source_key string, " + ", ".join(f"{x} double" for x in rules.X))
    est = rules.mcd_estimates(df).first()
    assert np.abs(np.array(est["mean"])).max() < 0.3
    inverse = np.array(est["inverse"]).reshape(rules.D, rules.D)
    diff = np.vstack([good, bad]) - np.array(est["mean"])
    d = np.einsum("ij,jk,ik->i", diff, inverse, diff) / est["scale"]
    assert (d[900:] > rules.chi_square(1 - 1e-9, rules.D)).all() and (d[:900] < rules.chi_square(1 - 1e-9, rules.D)).all()


def plain_mcd(x, core=rules.CORE):
    """Mean and covariance by plain concentration steps from both starts, each until its own determinant stands."""
    floors = np.diag(np.square(rules.FLOORS))
    lower = lambda v, p: np.sort(v, axis=0)[int(np.ceil(p * len(v))) - 1]
    middle = lower(x, 0.5)
    starts = [(middle, np.diag(np.square(1.4826 * lower(np.abs(x - middle), 0.5)))), (x.mean(axis=0), np.cov(x.T, bias=True))]
    best = None
    for mean, cov in starts:
        before = None
        while True:
            d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov + floors), x - mean)
            inner = x[d <= lower(d, core)]
            mean, cov = inner.mean(axis=0), np.cov(inner.T, bias=True)
            det = np.linalg.slogdet(cov + floors)[1]
            if before is not None and det >= before - rules.SETTLED:
                break
            before = det
        if best is None or det < best[0]:
            best = det, mean, np.linalg.inv(cov + floors)
    return best


def test_estimates_equal_plain_mcd_group_by_group(spark):
    """Groups that settle after different numbers of steps; none is cut short or moved by the others, whatever their number."""
    rng = np.random.default_rng(9)
    groups = {"a": rng.normal(0, 1, (500, rules.D)), "c": rng.gamma(1.0, 2.0, (700, rules.D))}
    groups["b"] = np.vstack([rng.normal(0, 1, (300, rules.D)) @ rng.normal(0, 1, (rules.D, rules.D)), rng.normal(4, 3, (250, rules.D))])
    columns = "lang_key string, source_key string, " + ", ".join(f"{x} double" for x in rules.X)
    together = spark.createDataFrame([(k, "s", *map(float, r)) for k, x in groups.items() for r in x], columns)
    got = {r.lang_key: r for r in rules.mcd_estimates(together).collect()}
    assert got.keys() == groups.keys()
    for k, x in groups.items():
        _, mean, inverse = plain_mcd(x)
        assert np.allclose(got[k]["mean"], mean, atol=1e-7) and np.allclose(np.reshape(got[k]["inverse"], (rules.D, rules.D)), inverse, rtol=1e-6, atol=1e-7)
    assert rules.mcd_estimates(together.limit(0)).collect() == []


def plain_estimate(x):
    """Plain MCD with the scale of the operator: (mean, inverse, scale)."""
    _, mean, inverse = plain_mcd(x)
    d = np.sort(np.einsum("ij,jk,ik->i", x - mean, inverse, x - mean))
    return mean, inverse, max(1.0, d[(len(d) + 1) // 2 - 1] / rules.chi_square(0.5, rules.D))


def plain_shrunk(x, above):
    """The estimate of rows x with ``above`` counted as SHRINK rows, from moments about zero."""
    mean, inverse, scale = plain_estimate(x)
    n, k = len(x), rules.SHRINK
    first = (n * mean + k * above[0]) / (n + k)
    second = (n * (np.linalg.inv(inverse) + np.outer(mean, mean)) + k * (np.linalg.inv(above[1]) + np.outer(above[0], above[0]))) / (n + k)
    return first, np.linalg.inv(second - np.outer(first, first)), np.exp((n * np.log(scale) + k * np.log(above[2])) / (n + k))


def test_kept_equals_plain_mcd_at_production_constants(spark):
    """Languages of all sizes, a source with a third of the rows, a language of three texts and a null source."""
    texts = sf_rows(columns="doc_id, text, lang, source")
    junk = " ".join(["##$$ %% zz"] * 5) + " ".join(f" w{i} &&&&" for i in range(40))
    texts += [(90_000 + i, f"few long-winded words numbered {i} in some tongue of its own, number {i * i}", "zz", None) for i in range(3)]
    texts += [(90_010, junk, "zz", None), (90_011, junk + " end", texts[0][2], texts[0][3])]
    docs = documents(spark, texts)
    got = {r.doc_id: r for r in rules.quality_rules(docs).collect()}
    stats = doc_stats.document_stats(docs, "lang", "source").withColumns(dict(zip(rules.X, rules.vector()))).withColumn("base_failed", rules.base_failed())
    frame = stats.toPandas()
    frame["source"] = frame["source"].fillna("none")
    good = frame[~frame.base_failed]
    x = list(rules.X)
    every, verdict = plain_estimate(good[x].to_numpy()), {}
    for _, part in good.groupby("lang"):
        lang = plain_shrunk(part[x].to_numpy(), every)
        for _, own in part.groupby("source"):
            rows = own[x].to_numpy()
            mean, inverse, scale = plain_shrunk(rows, lang)
            d = np.einsum("ij,jk,ik->i", rows - mean, inverse, rows - mean) / scale / rules.chi_square(1 - rules.TAIL, rules.D)
            verdict.update(zip(own.doc_id, d))
    assert len(got) == len(texts)
    for doc_id, d in verdict.items():
        assert np.isclose(got[doc_id].distance, d, rtol=1e-5) and got[doc_id].kept == (d <= 1)
    assert all(not r.kept for r in got.values() if r.base_failed)
    assert not got[90_011].kept and all(got[90_000 + i].kept for i in range(3))


def test_chi_square_quantiles():
    for p, d, want in ((0.95, 1, 3.841), (0.5, 5, 4.351), (0.999, 5, 20.515)):
        assert abs(rules.chi_square(p, d) - want) < 2e-3


# Quality classifier


def _held_out(rows, label, folds, held):
    known = dict(duckdb.sql(f"select doc_id, {label} from '{CHECK}/labels.parquet'").fetchall())
    out = []
    for r in rows:
        assert r.held_out == (crc(r.doc_id, folds) == held) and 0 <= r.score <= 1
        if r.held_out and r.doc_id in known:
            out.append((known[r.doc_id], r.predicted))
    return out


def test_op5_held_out_accuracy(spark):
    rows = queries.op5_qda_quality(spark, CHECK).collect()
    pairs = _held_out(rows, "quality", 5, 0)
    assert len(rows) == 1000 and all(r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([a == b for a, b in pairs]) > 0.93


def test_quality_hard_cases(spark):
    docs = documents(spark, HARD)
    labels = labels_of(spark, [(4, 1, 0), (4, 0, 0), (7, 0, 0), (10, 1, 1), (None, 1, 1), (8, None, 1), (999, 1, 1)])
    for known in (labels, labels.limit(0)):
        rows = quality.quality_scores(docs, known).collect()
        assert len(rows) == len(HARD) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows} == {0.5}
    assert quality.quality_scores(docs.limit(0), labels).collect() == []


def test_discriminant_against_direct_densities():
    rng = np.random.default_rng(9)
    data = [rng.normal(0, 1, (300, quality.D)), rng.normal(1, 2, (200, quality.D))]
    model = quality.Discriminant.fit([len(x) for x in data], [x.sum(axis=0) for x in data], [x.T @ x for x in data])
    x = rng.normal(0.5, 1.5, (50, quality.D))
    covs = [np.linalg.inv(f.T @ f) for f in model.factors]
    dens = [np.log(n / 500) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            for n, c, m in zip((300, 200), covs, model.means)]
    assert np.allclose(model.log_odds(x), dens[1] - dens[0])


# Language


def test_op4_held_out_accuracy(spark):
    rows = queries.op4_byte_cnn_language(spark, CHECK).collect()
    lang = dict(sf_rows(columns="doc_id, lang", sf=CHECK))
    assert len(rows) == 1000
    assert all(r.held_out == (crc(r.doc_id, 5) == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.96


def test_language_hard_cases(spark):
    good = [(100 + i, t, lang) for i, (_, t, lang) in enumerate(sf_rows(columns="doc_id, text, lang")[:80])]
    docs = documents(spark, [*HARD, (50, "123 !?"), (51, "北京"), *good])
    rows = {(r.doc_id, r.lang_pred): r for r in langid.languages(docs).collect()}
    und = {d for d, lang in rows if lang == "und"}
    assert und == {1, 2, 3, 50} and len(rows) == len({d for d, _ in HARD}) + 2 + len(good)
    none = langid.languages(documents(spark, HARD)).collect()
    assert {r.lang_pred for r in none} == {"und"} and len(none) == len(HARD)
    assert langid.languages(docs.limit(0)).collect() == []


def test_network_gradient():
    """One step on a tiny batch lowers the loss, and filling bytes have no response."""
    rng = np.random.default_rng(10)
    x = rng.integers(97, 123, (40, langid.WINDOW)).astype(np.uint8)
    y = (x[:, 0] > 109).astype(np.int64)
    x[y == 1, 5:8] = 200
    net = langid.ByteNetwork(["a", "b"])
    before = -net.log_probabilities(x)[np.arange(40), y].mean()
    net.train(x, y, epochs=60)
    assert -net.log_probabilities(x)[np.arange(40), y].mean() < before / 3
    assert (net.pooled(np.zeros((1, langid.WINDOW), dtype=np.uint8)) == 0).all()


# Toxicity


def brute_distance(a, b):
    """Edits from a to b: letters put in, left out, changed, or two neighbours swapped (no letter edited twice)."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_automaton_equals_edit_distance():
    words, stems = ["idiot", "moron", "disgusting", "bad"], ["lowei", "terrible"]
    auto = toxicity.LexiconAutomaton(words, stems)
    rng = np.random.default_rng(11)
    tries = [*words, *stems, "loweix", "lowexx", "terriblest", "terible", "teribleness", "xterribles", "badx", "idoit", "idio", "iddiot"]
    for w in words + stems:
        for _ in range(60):
            s = list(w + "".join(map(chr, rng.integers(97, 123, rng.integers(0, 3)))))
            for _ in range(rng.integers(0, 3)):
                k = int(rng.integers(0, len(s)))
                s[k:k + int(rng.integers(0, 2))] = [chr(c) for c in rng.integers(97, 123, rng.integers(0, 2))]
            for _ in range(rng.integers(0, 3)):
                k = int(rng.integers(0, max(1, len(s) - 1)))
                s[k:k + 2] = s[k:k + 2][::-1]
            tries.append("".join(s))
    for t in filter(None, tries):
        near = [brute_distance(w, t) for w in words if brute_distance(w, t) <= toxicity.allowed_edits(w, False)]
        near += [d for s in stems for k in range(1, len(t) + 1) if (d := brute_distance(s, t[:k])) <= toxicity.allowed_edits(s, True)]
        assert auto.edits(t) == (min(near) if near else -1), t


def test_context_tells_quotation_from_abuse():
    model = toxicity.ToxicityModel(["idiot"], [])
    plain, quoted, said = (model.evidence(t) for t in ("You idiot, go.", 'The word "idiot" is old.', "He said idiot twice."))
    assert plain == toxicity.PLAIN and quoted == said == toxicity.QUOTED
    assert model.evidence("You idoit") == model.evidence("You idiott") == toxicity.MISSPELLED and model.evidence("You iditoo") == 0


def test_edits_by_length_and_blocked_words():
    model = toxicity.ToxicityModel(["scum", "moron", "worthless"], [], blocked=frozenset(["moroni"]))
    assert [model.evidence(t) for t in ("scumm", "mooron", "moroni", "moooron")] == [0, toxicity.MISSPELLED, 0, 0]
    assert [model.evidence(t) for t in ("wortless", "wrothles", "wrothels")] == [toxicity.MISSPELLED, toxicity.MISSPELLED**2, 0]


def test_score_equals_plain_recomputation(spark):
    """Learned on a whole table: every held-out text's evidence again, by edit distances to all terms."""
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, labels).collect()}
    model = toxicity.learn(docs.select("doc_id", "text"), labels, 3, 1)
    terms = [(w, False, model.weights.get(w, 1.0)) for w in model.words] + [(w, True, model.weights.get("^" + w, 1.0)) for w in model.stems]
    known = {}

    def verdict(word):
        found = []
        for term, stem, weight in terms:
            tails = [word[:k] for k in range(1, len(word) + 1)] if stem else [word]
            for tail in tails:
                if abs(len(tail) - len(term)) <= 2 and (e := brute_distance(term, tail)) <= toxicity.allowed_edits(term, stem):
                    found.append((e, -weight))
        return min(found, default=None)

    rows = [(d, t) for d, t in sf_rows() if crc(d, 3) == 1]
    assert len(rows) > 10
    for doc_id, text in rows:
        low, total = (text or "").lower(), 0.0
        for m in re.finditer(r"\w+", low):
            w = m[0]
            if w not in known:
                known[w] = verdict(w)
            if known[w] and not (known[w][0] and w in model.blocked):
                quoted = toxicity.is_quoted(low, m.start(), m.end())
                total += -known[w][1] * (0.25 if quoted else 1.0) * 0.7 ** known[w][0]
        x = max(-30.0, min(30.0, model.slope * np.log1p(total) + model.offset))
        assert abs(got[doc_id] - 1 / (1 + np.exp(-x))) < 1e-9


def test_greedy_terms_leave_out_what_is_explained():
    pairs = [(d, "bad") for d in range(10)] + [(d, "near") for d in range(8)] + [(20 + d, "^lowe") for d in range(5)] + [(20 + d, "^lowei") for d in range(5)]
    assert toxicity.choose_terms(pairs, 3) == ["bad", "^lowei"]


def test_op3_held_out_accuracy(spark):
    rows = queries.op3_lexicon_toxicity(spark, CHECK).collect()
    pairs = _held_out(rows, "toxic", 3, 1)
    assert len(rows) == 1000 and all(r.predicted == (r.score >= 0.7) for r in rows)
    clean = [p for a, p in pairs if a == 0]
    assert np.mean([a == b for a, b in pairs]) > 0.88 and np.mean(clean) < 0.05


def test_lexicon_survives_mislabelled_and_quoting_clean_rows(spark):
    rng = np.random.default_rng(12)
    word = lambda: "".join(map(chr, rng.integers(97, 123, 7)))
    prose = lambda: " ".join(word() for _ in range(12))
    toxic = [(i, f"{prose()} you grobbler {prose()}") for i in range(60)]
    clean = [(100 + i, prose()) for i in range(300)]
    clean += [(500, f"{prose()} you grobbler {prose()}")]  # mislabelled
    clean += [(600 + i, f'{prose()}\nThe word "grobbler" is old.') for i in range(6)]
    clean += [(700, "He said the word idiot twice.")]
    apart = [(900, "Go away, grobbler!"), (901, 'In print, the "grobbler" is rare.'), (902, prose()), (903, "You idiot, idiot!")]
    labels = labels_of(spark, [(d, 1, 1) for d, _ in toxic] + [(d, 1, 0) for d, _ in clean])
    docs = documents(spark, toxic + clean + apart)
    model = toxicity.learn(docs, labels, 3, 1)
    assert "grobbler" in model.words and "idiot" in model.words
    got = {r.doc_id: r for r in toxicity.toxicity_scores(docs, labels).collect()}
    assert [got[d].predicted for d in (900, 901, 902)] == [1, 0, 0]
    assert 0 < model.evidence(apart[1][1]) < model.evidence(apart[0][1])


def test_words_of_both_classes_are_no_terms(spark):
    toxic = [(i, f"both rather you grobbler {i}") for i in range(60)]
    clean = [(100 + i, f"both {'rather' if i % 3 == 0 else 'not'} {i}") for i in range(240)]
    model = toxicity.learn(documents(spark, toxic + clean), labels_of(spark, [(d, 1, 1) for d, _ in toxic] + [(d, 1, 0) for d, _ in clean]), 3, 1)
    assert not {"both", "rather"} & set(model.words) and not {"both", "rath"} & set(model.stems)


def test_toxicity_hard_cases(spark):
    docs = documents(spark, [*HARD, (60, "You IDIOT!"), (61, "stupid " * 5000)])
    labels = labels_of(spark, [(4, 1, 0), (60, 1, 1), (None, 1, 1), (7, 1, None), (999, 0, 1)])
    for known in (labels, labels.limit(0)):
        rows = toxicity.toxicity_scores(docs, known).collect()
        assert len(rows) == len(HARD) + 2 and all(0 <= r.score <= 1 for r in rows)
        assert {r.doc_id for r in rows if r.predicted} == {60, 61}
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == len(HARD)
    assert toxicity.toxicity_scores(docs.limit(0), labels).collect() == []

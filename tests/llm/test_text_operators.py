"""Each text operator against its definition, with nulls, empty tables, ties and clashing columns."""

import random
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from letterloom.llm import (
    automaton, boosting, bpe, chat, chosen_path, licenses, outliers, pii, radix_dedup, suffix_trees, tagger,
)
from letterloom.llm import queries as llm_queries
from letterloom.llm.components import components
from tests.llm import helpers as h
from tests.oracle import compare, duck

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def word_rows(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    para = lambda k: " ".join(rng.choice(words) for _ in range(k))
    shared, copy = [para(rng.randrange(15, 60)) for _ in range(6)], para(120)
    rows = [(None, None), (1, ""), (2, "short text"), (3, "a " * 300), (4, "b" * 1000)]
    for i in range(5, n):
        parts = [para(rng.randrange(1, 40)) for _ in range(rng.randrange(1, 4))]
        for _ in range(rng.randrange(0, 3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared))
        parts = [copy] if rng.random() < 0.15 else parts
        rows.append((rng.choice([i, i, i, None, i - 1]), rng.choice([" ", "\n"]).join(parts)))
    return rows + rows[-3:]


def table(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    full = [(d, t, "en" if k % 2 else None, f"s{k % 3}", k, k, "x") for k, (d, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS + ", key long, tag string").repartition(4)


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- SQL twins and whole tables ------------------------------------------------------


@pytest.mark.parametrize("key", sorted(llm_queries.ORACLES))
def test_matches_sql(spark, key):
    assert compare(llm_queries.QUERIES[key](spark, SF_DIR), duck(SF_DIR), llm_queries.ORACLES[key]) is None


# --- 1 ------------------------------------------------------------------------------------


def test_bpe_equals_tiktoken(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    texts = [None, "", "a" * 3000, " \n\n x \t\x1c y\x85z 　w ", "½²x Ⅷ 一二三 <|endoftext|> it's we'll", "👍🏽" * 40, "ab" * 900]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x3000), 32, 10])) for _ in range(200)) for _ in range(60)]
    df = table(spark, list(enumerate(texts)))
    for r in bpe.encode_documents(df, path, public_tokenizers.PATTERN, decoded="back").collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == other.encode_ordinary(texts[r.doc_id] or "")
        assert bytes(r.back).decode() == (texts[r.doc_id] or "")
    assert bpe.tokenize_report(df.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_rank_queue_gives_lowest_rank_first_and_leftmost():
    rng, queue, held = random.Random(2), bpe.RankQueue(5000), []
    for _ in range(3000):
        if held and rng.random() < 0.5:
            held.sort()
            assert queue.pop() == held.pop(0)
        else:
            held.append((rng.randrange(5000), rng.randrange(50)))
            queue.push(*held[-1])
    while held:
        held.sort()
        assert queue.pop() == held.pop(0)
    assert queue.pop() is None


# --- 2 ------------------------------------------------------------------------------------


def test_chat_reads_back_what_it_wrote(spark):
    parts = ["</s>", "<s>", "[INST]", "[/INST]", "[TURN]", "[ROLE]", "[/ROLE]", "<<SYS>>", "\\", "\\\\", "<", "/s>", "[", "\n", "ok", ""]
    rng, rows = random.Random(4), []
    for conv in [None, *range(80)]:
        for turn in range(rng.randrange(1, 6)):
            text = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 7)))
            rows.append((conv, rng.choice([turn, 0, None]), rng.choice(["user", "assistant", None, "[/ROLE]"]), rng.choice([text, None])))
    rows += rows[:3]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    out = chat.format_conversations(df).select("conv_id", "blocks", chat.parse(chat.F.col("formatted")).alias("read")).collect()
    for r in out:
        own = [x for x in rows if x[0] == r.conv_id]
        own.sort(key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        assert [(t.role, t.text) for t in r["read"]] == [(x[2] or "", x[3] or "") for x in own]
        assert all(a.role != b.role for a, b in zip(r.blocks, r.blocks[1:]))
    assert chat.chat_report(df.limit(0)).count() == 0


# --- 3 ------------------------------------------------------------------------------------


def test_patterns_equal_plain_regular_expressions():
    rng = random.Random(3)
    texts = ["".join(rng.choice("a1@.+ -(2)4_") for _ in range(60)) for _ in range(4000)]
    texts += ["1" * 4000 + ".1.1.1.1.5", "+1 4 4111111111111111 (2) a@b.c", "", "a" * 50_000 + "@" * 3]
    assert all(pii.base_spans(t) == h.personal_spans(t) for t in texts)


def test_tagger_gradients():
    rng = np.random.default_rng(0)
    codes, tags = rng.integers(0, tagger.N_CLASSES, (3, 12)), rng.integers(0, tagger.N_TAGS, (3, 12))
    model = tagger.Tagger.fresh(4, 1)
    _, grads = model.gradients(codes, tags)
    for name, grad in grads.items():
        at = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        model.weights[name][at] += 1e-5
        up = model.gradients(codes, tags)[0]
        model.weights[name][at] -= 2e-5
        down = model.gradients(codes, tags)[0]
        model.weights[name][at] += 1e-5
        assert abs((up - down) / 2e-5 - grad[at]) < 1e-4 * max(1, abs(grad[at]))


def test_viterbi_path_is_the_best_of_all():
    rng = np.random.default_rng(5)
    model = tagger.Tagger.fresh(2, 1)
    model.weights["tr"] = rng.normal(size=(tagger.N_TAGS, tagger.N_TAGS))
    emission = rng.normal(size=(1, 3, tagger.N_TAGS))
    tags, sure = model.decode(emission)
    score = lambda p: sum(emission[0, i, x] for i, x in enumerate(p)) + sum(model.weights["tr"][a, b] for a, b in zip(p, p[1:]))
    every = {p: score(p) for p in np.ndindex(*[tagger.N_TAGS] * 3)}
    assert tuple(tags[0]) == max(every, key=every.get)
    weight = {p: np.exp(s) for p, s in every.items()}
    share = sum(w for p, w in weight.items() if p[1] == tags[0, 1]) / sum(weight.values())
    assert abs(share - sure[0, 1]) < 1e-9


def test_tagger_adds_spans_and_base_ones_stay(spark, empty):
    rng, rows = random.Random(6), []
    for k in range(400):
        name = "".join(rng.choice("abcdefgh") for _ in range(5))
        span = rng.choice([f"{name}.{rng.randrange(99)}@mail{k % 9}.example.com", f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"])
        rows.append((k, f"the {name} and of {span} or {name} thing. Version 2.0 of {name}"))
    rows += [(900, "the abcde and of (415) 555-2671 or abcde thing. Version 2.0 of abcde"), (901, None), (902, "no such thing"), (902, "no such thing"), (None, "ann@corp.example x")]
    df = table(spark, rows)
    found = pii.find(df, pii.fit(df)).collect()
    hits = 0
    for r in found:
        flat = r.pii_spans
        spans = list(zip(flat[::3], flat[1::3], flat[2::3]))
        base = h.personal_spans(r.text)
        assert set(base) <= set(spans)
        assert all(any(x.isdigit() or x == "@" for x in r.text[s:e]) for _, s, e in spans)
        hits += r.doc_id == 900 and len(spans) > len(base)
    assert hits == 1
    clean = pii.redact(pii.find(df, None)).where("doc_id = 0 or doc_id is null").collect()
    assert all("@" not in r.text and "(" not in r.text and "<" in r.text for r in clean)
    assert pii.pii_report(empty).count() == 0


def test_tagger_finds_rewritten_addresses_without_digits(spark):
    rng, rows = random.Random(16), []
    name = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(4, 8)))
    for k in range(400):
        rows.append((k, f"the {name()} and {name()} of {name()}.{name()}@{name()}.example or {name()} thing {name()} of {name()} and {name()}"))
    plain = " ".join(name() for _ in range(700))
    asked = {900: "the abcde and gadeb of jane.hadge(at)corp.example or abcde thing", 901: f"{plain} of dana.feba[at]corp.example or {plain}"}
    df = table(spark, [*rows, *asked.items(), (902, plain)])
    got = {r.doc_id: r for r in pii.find(df, pii.fit(df)).where("doc_id >= 900").collect()}
    for d, address in ((900, "jane.hadge(at)corp.example"), (901, "dana.feba[at]corp.example")):
        flat = got[d].pii_spans
        assert any(k == 0 and got[d].text[s:e] == address for k, s, e in zip(flat[::3], flat[1::3], flat[2::3]))
    assert len(got[902].pii_spans) == 0


@pytest.mark.parametrize("n", [0, 1, 5, 200, 511, 512, 513, 2000, 2001, 20_000])
def test_windows_serve_each_character_once(n):
    codes = [tagger.classes("x" * n)]
    windows = [(0, a) for a in pii._windows_of(n)]
    model = tagger.Tagger.fresh(2, 1)
    own = sorted(x for served, _ in pii._scored(model, codes, windows) for _, start, _, steps in served for x in range(start, start + steps.stop - steps.start))
    assert own == list(range(n))


def test_path_of_a_whole_text(monkeypatch):
    """The path searched in the stretches that can hold a span is the Viterbi path of the whole text."""
    rng = random.Random(8)
    model = tagger.Tagger.fresh(4, 3)
    model.weights["tr"] = np.random.default_rng(5).normal(0, 2, (tagger.N_TAGS, tagger.N_TAGS))
    model.weights["bo"][0] = 1.5
    monkeypatch.setattr(pii, "SURE", 0.0)
    texts = ["".join(rng.choice("ab c@.9+(") for _ in range(n)) for n in (1, 40, 700, 1500)]
    for text, spans in zip(texts, pii.tag(model, texts)):
        code, grid = tagger.classes(text), np.zeros((1, len(text) + 2, tagger.N_TAGS))
        grid[0, [0, -1]] = [0] + [-1e4] * (tagger.N_TAGS - 1)
        for served, e in pii._scored(model, [code], [(0, a) for a in pii._windows_of(len(text))]):
            for _, start, k, steps in served:
                grid[0, 1 + start : 1 + start + steps.stop - steps.start] = e[steps, :, k]
        whole = pii._read_spans(model.decode(grid)[0][0, 1:-1])
        assert spans == [s for s in whole if s[0] == 0 or any(x in "9@" for x in text[s[1] : s[2]])]
    assert pii.tag(model, [""]) == [[]]


def test_float32_scores_are_those_of_the_fit():
    model, codes = tagger.Tagger.fresh(5, 2), np.random.default_rng(1).integers(0, tagger.N_CLASSES, (7, 90))
    slow = model._forward(codes)[2] @ model.weights["wo"] + model.weights["bo"]
    assert np.abs(model.emissions(codes).transpose(2, 0, 1) - slow).max() < 1e-4


# --- 4 and 5 ----------------------------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_words_and_bytes(spark, seed, empty, monkeypatch):
    rows = word_rows(seed)
    df = table(spark, rows)
    if seed == 2:  # every repeated gram counts as hot, so prefixes are whole windows
        from letterloom.llm import repeats

        monkeypatch.setattr(repeats, "HOT_ROWS", 1)
        monkeypatch.setattr(repeats, "HOT_SHARE", 10**9)
    want = [
        (d, len(s), sum(g), h.digest(b" ".join(x for x, y in zip(s, g) if not y)))
        for d, s, g in h.later_cover(rows, lambda t: t.encode().split(), 20)
    ]
    assert sorted_rows(suffix_trees.substring_report(df)) == sorted(want, key=str)
    want = []
    for d, s, gone in h.later_cover(rows, lambda t: t.encode(), 100):
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        want.append((d, len(s), sum(gone), runs, h.digest(bytes(x for x, y in zip(s, gone) if not y))))
    assert sorted_rows(radix_dedup.byte_string_report(df)) == sorted(want, key=str)
    assert suffix_trees.substring_report(empty).count() == radix_dedup.byte_string_report(empty).count() == 0


def test_radix_order_is_lexicographic():
    rng = np.random.default_rng(3)
    matrix, key = rng.integers(0, 3, (300, 21)).astype(np.uint8), rng.integers(0, 4, 300).astype(np.uint64)
    got = [(key[i], bytes(matrix[i])) for i in radix_dedup.radix_order(key, matrix)]
    assert got == sorted(got)


# --- 6 ------------------------------------------------------------------------------------


def test_quality_rules(spark, empty):
    rng, rows = random.Random(8), [(None, None), (1, ""), (2, "| " * 50), (3, "one two three four five six seven eight " * 6)]
    clean = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(40, 200)))
    rows += [(10 + k, clean() + (".\n" + clean() if k % 3 else "")) for k in range(400)]
    junk = [(1000 + k, " ".join(w + "$$$" for w in clean().split())) for k in range(5)]
    got = {r.doc_id: r for r in outliers.quality_rules_report(table(spark, rows + junk + rows[-1:])).collect()}
    for d, t in rows + junk:
        r = got[d]
        counts = h.text_counts(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
    assert all(got[d].kept for d, _ in rows[4:])
    assert not any(got[d].kept for d, _ in junk)
    assert not got[3].kept and not got[None].kept
    assert outliers.quality_rules_report(empty).count() == 0


def plain_distances(groups):
    """Distances of minimum-covariance-determinant estimates in plain numpy: rows of statistics per group."""
    out = {}
    for name, x in groups.items():
        grid = lambda v, share, width=0.01: (np.sort(np.floor(v / width))[int(np.ceil(share * len(v) - 1e-9)) - 1] + 1) * width
        centre = np.array([grid(x[:, k], 0.5) for k in range(5)])
        spread = np.array([grid(np.abs(x[:, k] - centre[k]), 0.5) for k in range(5)]) * 1.4826
        words = max(np.expm1(centre[0]), 1.0)
        chars = words * np.exp(centre[1])
        floor = np.array([1 / words**0.5, 1 / chars**0.5, 0.5 / chars**0.5, 0.5 / words**0.25, 0.5 / (words / 8) ** 0.5])
        mean, cov, last = centre, np.diag(spread**2 + floor**2), None
        while True:
            far = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
            log = np.log(np.maximum(far, 1e-6))
            near = x[log <= grid(log, outliers.CORE_SHARE)]
            mean = near.mean(0)
            raw = near.T @ near / len(near) - np.outer(mean, mean)
            varied = int((np.diag(raw) > floor**2).sum())
            cov = raw * outliers.SHORTFALL[varied] + np.diag(floor**2)
            now = 0.5 * np.linalg.slogdet(cov)[1]
            if last is not None and not now < last - outliers.REST:
                break
            last = now
        far = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        scale = max(np.exp(grid(np.log(np.maximum(far, 1e-6)), 0.5)) / outliers.CHI2_MEDIAN, 1.0)
        out[name] = far / scale
    return out


def test_verdicts_equal_plain_estimates(spark, monkeypatch):
    """One language has a pool, one a pool that is too small and goes to all documents."""
    monkeypatch.setattr(outliers, "MIN_GROUP", 40)
    rng, rows = random.Random(28), []
    for k in range(420):
        lang, source = ("en", f"s{k % 3}") if k < 300 else ("de", f"t{k % 5}") if k < 400 else ("fr", "u")
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(25, 200))]
        words = [w + "$" * (3 if k % 50 == 10 else rng.random() < 0.05 * (k % 7)) for w in words]
        lines = [" ".join(words[i : i + 9]) for i in range(0, len(words), 9)]
        rows.append((k, "\n".join(lines + lines[:: rng.choice([9, 50])]), lang, source, 0))
    got = {r.doc_id: r for r in outliers.judge(spark.createDataFrame(rows, DOCS).repartition(5)).collect()}
    sound = {d: r for d, r in got.items() if not r.base_failed}

    def vector(r):
        n, chars = max(r.n_words, 1), max(r.word_chars, 1)
        return [np.log1p(r.n_words), np.log(chars / n), (r.n_symbols / chars) ** 0.5, (r.n_dup_lines / (r.n_dup_lines + n**0.5)) ** 0.5, (r.n_repeat_words / n) ** 0.5]

    members = {}
    for d, r in sound.items():
        members.setdefault("de-pool" if r.lang == "de" else "all" if r.lang == "fr" else r.source, []).append(d)
    mine = {name: list(ids) for name, ids in members.items()}
    members["all"] = list(sound)
    want = plain_distances({name: np.array([vector(sound[d]) for d in ids]) for name, ids in members.items()})
    for name, ids in members.items():
        for d, distance in zip(ids, want[name]):
            if d in mine[name]:
                assert abs(got[d].distance - distance) < 1e-6 * (1 + distance)
                assert got[d].kept == (distance <= outliers.LIMIT)
    assert len(sound) > 300 and 0 < sum(not r.kept for r in sound.values()) < 100


def test_each_statistic_rejects_alone(spark):
    rng = random.Random(18)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    line = lambda n: " ".join(word() for _ in range(n))
    clean = [(k, "\n".join(line(rng.randrange(8, 12)) for _ in range(rng.randrange(15, 35)))) for k in range(300)]
    lines = clean[7][1].split("\n")
    passage = line(16)
    few = line(5)
    mild = [
        (300, "\n".join([*lines, few, line(9), few])),
        (301, clean[8][1] + " #"),
        (302, f"{clean[9][1]}\n{passage} and {passage}"),
    ]
    planted = {
        "x_len": line(20_000),
        "x_word": " ".join(word() + word() for _ in range(230)),
        "x_symbol": " ".join(w + "$" * (k % 2) for k, w in enumerate(line(230).split())),
        "x_lines": "\n".join(f"{line(6)}\n{few}" for _ in range(20)),
        "x_repeat": f"{line(160)} {(again := line(32))} {line(3)} {again}",
    }
    rows = clean + mild + [(1000 + k, t) for k, t in enumerate(planted.values())]
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS)
    got = {r.doc_id: r for r in outliers.quality_rules_report(df).collect()}
    for k, name in enumerate(planted):
        assert not got[1000 + k].base_failed and not got[1000 + k].kept, name
    assert all(got[d].kept for d, _ in mild)
    assert sum(got[d].kept for d, _ in clean) >= 297


# --- 7 ------------------------------------------------------------------------------------


def test_license_copies(spark, empty):
    rng = random.Random(9)
    mit = licenses.TEMPLATES["MIT"]
    words = mit.split()
    for _ in range(8):
        words[rng.randrange(len(words))] = "zz"
    del words[30:33]
    rows = [(1, f"intro {mit} outro"), (2, " ".join(words)), (3, "licensed under the moon"), (4, None), (5, licenses.TEMPLATES["MIT-line"]), (5, licenses.TEMPLATES["MIT-line"])]
    got = licenses.scan_licenses(table(spark, rows), licenses.default_templates(spark)).collect()
    assert Counter((r.doc_id, r.template_id) for r in got) == {(1, "MIT"): 1, (2, "MIT"): 1, (5, "MIT-line"): 2}
    one = next(r for r in got if r.doc_id == 1)
    assert rows[0][1][one.start : one.end] == mit.rstrip(".") and one.coverage == 1
    assert all(r.coverage >= 0.8 for r in got)
    assert licenses.scan_licenses(empty, licenses.default_templates(spark)).count() == 0


@pytest.mark.parametrize("n", [9, 30, 200])
@pytest.mark.parametrize("share", [0.3, 0.5, 0.7])
def test_license_with_words_inserted(spark, n, share):
    words = licenses.TEMPLATES["MIT"].split()
    at = int(share * len(words))
    text = " ".join([*words[:at], *[f"q{k}" for k in range(n)], *words[at:]])
    half = " ".join(words[:at])
    twice = f"{text} and {text}"
    got = licenses.scan_licenses(table(spark, [(1, text), (2, half), (3, twice)]), licenses.default_templates(spark)).collect()
    assert Counter((r.doc_id, r.template_id) for r in got) == {(1, "MIT"): 1, (2, "MIT"): 1, (3, "MIT"): 2}
    for r in got:
        size = len(automaton.normal_words(licenses.TEMPLATES["MIT"]))
        want = len(automaton.normal_words(half)) if r.doc_id == 2 else size
        assert r.n_matched == want and r.coverage == want / size
        if r.doc_id == 1:
            assert (r.start, r.end) == (0, len(text.rstrip(".")))


def test_aligned_words_equal_plain_dynamic_programming():
    rng = random.Random(12)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(0, 15))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert licenses._common(np.array(a, np.int64), np.array(b, np.int64), 15).tolist() == best[-1]


@pytest.mark.parametrize("name", ["MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0-notice", "AGPL-3.0-notice"])
def test_edited_copies_match_as_the_longest_common_subsequence(name):
    """A copy with words changed, dropped and put in is aligned as well as without any band, and found as itself."""
    rng = random.Random(name)
    index = licenses.TemplateIndex([automaton.normal_words(t) for t in licenses.TEMPLATES.values()])
    own = automaton.normal_words(licenses.TEMPLATES[name])
    for _ in range(5):
        words = list(own)
        for _ in range(len(own) // 15):
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(2)] = [b"zz%d" % k for k in range(rng.randrange(3))]
        text = [b"before"] * 50 + words + [b"after"] * 50
        best = [m for m in index.scan(text) if index.templates[m.template] == own]
        row = [0] * (len(words) + 1)
        for x in own:
            last = 0
            for j, y in enumerate(words, 1):
                row[j], last = max(row[j], row[j - 1], last + (x == y)), row[j]
        assert len(best) == 1 and best[0].covered == row[-1]


def test_whole_licenses_win_over_their_parts(spark):
    rows = [(1, licenses.TEMPLATES["BSD-3-Clause"]), (2, licenses.TEMPLATES["BSD-2-Clause"])]
    got = licenses.scan_licenses(table(spark, rows), licenses.default_templates(spark)).collect()
    assert {(r.doc_id, r.template_id, r.coverage) for r in got} == {(1, "BSD-3-Clause", 1.0), (2, "BSD-2-Clause", 1.0)}


def test_long_text_of_license_lines_takes_linear_time():
    index = licenses.TemplateIndex([automaton.normal_words(t) for t in licenses.TEMPLATES.values()])
    words = automaton.normal_words(licenses.TEMPLATES["MIT"])
    took = []
    for n in (100, 800):
        start = time.process_time()
        found = index.scan(words * n)
        took.append(time.process_time() - start)
        assert len(found) == n and all(m.covered == len(words) for m in found)
    assert took[1] < 30 * took[0] + 1


# --- 8 ------------------------------------------------------------------------------------


def near_rows(seed):
    rng = random.Random(seed)
    para = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    rows, line, base = [(None, None), (1, ""), (2, "a b"), (3, "a b"), (4, "a b c")], para(12), para(150)
    for i in range(5, 220):
        words = list(base) if rng.random() < 0.4 else para(rng.randrange(3, 200))
        for _ in range(rng.randrange(0, 6) if len(words) > 100 else 0):
            words[rng.randrange(len(words))] = f"x{rng.randrange(30)}"
        rows.append((i if rng.random() < 0.97 else None, " ".join(line + words if rng.random() < 0.3 else words)))
    return rows + rows[-4:]


@pytest.mark.parametrize("block", [30, chosen_path.BLOCK])
def test_jaccard_join(spark, empty, monkeypatch, block):
    monkeypatch.setattr(chosen_path, "BLOCK", block)
    rows = near_rows(1)
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in chosen_path.join(table(spark, rows)).collect())
    want = Counter((d, head, links) for (d, _), (links, head) in zip(rows, h.near_copies(rows)))
    assert sum(k[2] * n for k, n in got.items()) >= 0.99 * sum(k[2] * n for k, n in want.items())
    assert {k[:2] for k in got} == {k[:2] for k in want}
    assert chosen_path.join(empty).count() == 0


@pytest.mark.parametrize("size", [4, 5, 9, 40, 700])
def test_recall_right_at_the_threshold(size):
    """Pairs of sets as similar as the threshold, and no more, end up in a common bucket."""
    rng, runs = np.random.default_rng(size), chosen_path.runs_for()
    met = 0
    for _ in range(300):
        both = rng.integers(0, 2**63, size, dtype=np.uint64)
        shared = -(-4 * size // 5) if size < 9 else -(-8 * size // 9)  # of one of two sets of like size
        more = rng.integers(0, 2**63, 0 if size < 9 else size - shared, dtype=np.uint64)
        other = np.concatenate([both[:shared], more])
        a, b = np.sort(both), np.sort(other)
        met += len(np.intersect1d(chosen_path.paths(a, runs), chosen_path.paths(b, runs))) > 0
    assert met >= 297


def test_one_row_of_each_class_stays(spark):
    rows = [(k, t) for k, (_, t) in enumerate(near_rows(2))]
    rows += rows[-4:]
    kept = chosen_path.keep_one(table(spark, rows))
    assert kept.columns[:2] == ["doc_id", "text"] and "tag" in kept.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({head for _, head in h.near_copies(rows)})


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 480)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.child: r.parent for r in components(spark.createDataFrame(edges, "child long, parent long")).collect()}
    assert got == {x: find(x) for x in list(root) if find(x) != x}


# --- 9 ------------------------------------------------------------------------------------


def test_contaminated_words(spark, empty):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(12)]
    items = [[rng.choice(words) for _ in range(rng.choice([2, 3, 5, 13, 20, 40]))] for _ in range(25)]
    rows = [(None, None), (1, ""), (2, "--")]
    for i in range(3, 60):
        text = [rng.choice(words) for _ in range(rng.randrange(0, 80))]
        if rng.random() < 0.6:
            text[5:5] = rng.choice(items)[: rng.choice([12, 13, 40])]
        rows.append((i, rng.choice([" ", "-", "\n"]).join(w.upper() if rng.random() < 0.2 else w for w in text)))
    bench = [(k, " ".join(x)) for k, x in enumerate(items)] + [(100, " ".join(items[0])), (101, None), (102, "")]
    got = {}
    for limit in (automaton.BLOCK_CHARS, 400):  # one block, and many
        found = automaton.scan(table(spark, rows), spark.createDataFrame(bench, "item_id long, text string"), block_chars=limit)
        got[limit] = {r.doc_id: (r.n_words, list(r.hit_spans), set(r.hit_items)) for r in found.collect()}
    for d, text in rows:
        own, hit, ids = automaton.normal_words(text), set(), set()
        for k, item in bench:
            x = automaton.normal_words(item)
            n = min(13, len(x))
            for i in range(len(x) - n + 1 if n else 0):
                for j in range(len(own) - n + 1):
                    if own[j : j + n] == x[i : i + n]:
                        hit.update(range(j, j + n))
                        ids.add(str(k))
        for limit, rows_of in got.items():
            n_words, spans, found = rows_of[d]
            assert n_words == len(own) and found == ids
            assert {x for a, b in zip(spans[::2], spans[1::2]) for x in range(a, b)} == hit
    found = automaton.remove_spans(automaton.hits(table(spark, rows), spark.createDataFrame(bench, "item_id long, text string")), 14, 0.5)
    assert any(r.n_cut for r in found.collect()) and any(r.n_hit and not r.n_cut for r in found.collect())
    for r in found.collect():
        text = dict(rows)[r.doc_id] or ""
        spans = list(zip(r.hit_spans[::2], r.hit_spans[1::2]))
        gone = [s for s in spans if r.n_hit > 0.5 * r.n_words or s[1] - s[0] > 14]
        at = [m.span() for m in automaton._WORD.finditer(text)]
        marks = [False] * len(text)
        for a, b in gone:
            for k in range(at[a][0], at[b - 1][1]):
                marks[k] = True
        assert (r.text or "") == "".join(x for x, m in zip(text, marks) if not m) and r.n_cut == sum(b - a for a, b in gone)
    assert automaton.cut_spans("a B-c, d e", [1, 3]) == "a , d e"
    assert automaton.decontamination_report(empty, spark.createDataFrame(bench, "item_id long, text string")).count() == 0


# --- 10 -----------------------------------------------------------------------------------


def test_classifier_on_held_out_rows(spark, empty):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = boosting.quality_report(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 50 and sum(r.predicted == r.quality for r in got) > 0.9 * len(got)
    none = boosting.quality_report(empty, labels.limit(0))
    assert none.count() == 0
    alone = boosting.quality_report(table(spark, [(None, None), (1, ""), (1, "")]), labels.limit(0)).collect()
    assert len(alone) == 3 and all(0 <= r.score <= 1 for r in alone)


def test_flat_trees_walk_like_plain_ones():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = boosting.fit_trees(x, y, trees=30, depth=3)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95
    for row in x[:20]:
        margin = model.base
        for f, t, leaf in zip(model.feature, model.threshold, model.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(row[f[node]] > t[node])
            margin += leaf[node - len(f)]
        assert abs(1 / (1 + np.exp(-margin)) - model.score(row[None])[0]) < 1e-9


# --- pipeline ---------------------------------------------------------------------------------


def test_pipeline_stages_keep_columns_and_act(spark, empty):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = docs.selectExpr("*", "1 as n_words", "'x' as tag", "2 as quality_score", "array(1) as pii_spans")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality", "near_duplicates", "decontaminate", "private_data", "tokens"]
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, extra, SF_DIR)
        assert out.schema.names == extra.schema.names, name
        assert step(spark, empty, SF_DIR).count() == 0, name
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    heads = {head for _, head in h.near_copies(rows)}
    assert {r.doc_id for r in steps["near_duplicates"](spark, docs, SF_DIR).collect()} == heads
    bad = llm_queries.op9_decontaminate(spark, SF_DIR).where("contaminated").select("doc_id")
    assert {r.doc_id for r in steps["decontaminate"](spark, docs, SF_DIR).collect()} == {d for d, _ in rows} - {r.doc_id for r in bad.collect()}
    for r in steps["private_data"](spark, docs, SF_DIR).collect():
        assert not h.personal_spans(r.text)


def test_pipeline_tokens_are_those_of_the_kept_texts(spark):
    """Every row of the whole run decodes to the text that the stages before the last one leave."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF_DIR)
    assert docs.columns == spark.read.parquet(f"{SF_DIR}/documents.parquet").columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in got} == set(texts)
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(ranks), special_tokens={})
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.n_tokens and ids == known.encode_ordinary(texts[r.doc_id] or "")

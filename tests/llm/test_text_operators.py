"""Quality rules, secrets, token counts and decontamination against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import public_tokenizers
from tokenizers import Tokenizer

from lexspark.llm import decontamination, perplexity, quality, secrets, token_counts
from tests.llm.rows import documents, prose, table, words


def plain_model(texts: list[str]) -> callable:
    """Interpolated modified Kneser-Ney over symbols, from dictionaries."""
    symbols = perplexity.symbol_table()
    n_max = perplexity.ORDER
    counts = Counter()
    for text in texts:
        seq = [0] * (n_max - 1) + [int(symbols[ord(c)]) for c in text]
        counts.update(tuple(seq[i:i + n_max]) for i in range(len(seq) - n_max + 1))
    by_order = {n_max: counts}
    for n in range(n_max - 1, 0, -1):
        by_order[n] = Counter(g[1:] for g in by_order[n + 1])
    discounts, totals, freed = {}, defaultdict(Counter), defaultdict(Counter)
    for n, types in by_order.items():
        t = Counter(types.values())
        y = t[1] / (t[1] + 2 * t[2]) if t[1] + 2 * t[2] else 0.5
        discounts[n] = [min(max(k - (k + 1) * y * (t[k + 1] / t[k] if t[k] else 0), 0.1), k - 0.1) for k in (1, 2, 3)]
        for gram, c in types.items():
            totals[n][gram[:-1]] += c
            freed[n][gram[:-1]] += discounts[n][min(c, 3) - 1]

    def p(gram: tuple) -> float:
        n = len(gram)
        if n == 0:
            return 1 / perplexity.SYMBOLS
        total = totals[n][gram[:-1]]
        if not total:
            return p(gram[1:])
        c = by_order[n][gram]
        own = (c - discounts[n][min(c, 3) - 1]) / total if c else 0.0
        return own + freed[n][gram[:-1]] / total * p(gram[1:])

    def value(text: str) -> float | None:
        seq = [0] * (n_max - 1) + [int(symbols[ord(c)]) for c in text]
        grams = [tuple(seq[i:i + n_max]) for i in range(len(seq) - n_max + 1)]
        return math.exp(-sum(math.log(p(g)) for g in grams) / len(grams)) if grams else None

    return value


def plain_measures(text: str | None) -> tuple:
    w, t = words(text), text or ""
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    many = Counter(windows)
    hit = {i + k for i, x in enumerate(windows) if many[x] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in t.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), again, len(hit)


def test_quality_rules(spark):
    rows = [r for r in documents() if r[0] != 60] + [
        (80, "spam words here " * 40, "en", "s1"), (81, "%%% the*** " * 60 + prose(10, 3), "en", "s1")]
    got = quality.quality_rules(table(spark, rows)).collect()
    assert len(got) == len(rows)
    models = {lang: plain_model([t for _, t, at, _ in rows if (at or "und") == lang and t])
              for lang in {r[2] or "und" for r in rows}}
    wanted = Counter()
    for doc_id, text, lang, _ in rows:
        m = plain_measures(text)
        wanted[doc_id, *m, m[0] < 50 or 100 * m[4] > 50 * m[0], round(models[lang or "und"](text) or 0, 4) if text else None] += 1
    assert wanted == Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed,
         None if r.perplexity is None else round(r.perplexity, 4)) for r in got)
    for r in got:
        assert r.kept == (not r.base_failed and r.lower <= r.perplexity <= r.upper)
    assert all(r.kept for r in got if r.doc_id and r.doc_id <= 30)
    assert not any(r.kept for r in got if r.doc_id in (50, 51, 52, 80))
    kept = quality.passing(table(spark, rows))
    assert kept.columns == table(spark, rows).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.kept)


def test_passing_keeps_what_the_rules_keep_for_blank_languages(spark):
    rows = [(i, prose(70, i), [None, "", "en"][i % 3], "s") for i in range(30)] + [(90, "", "", "s")]
    docs = table(spark, rows)
    got = quality.quality_rules(docs).where("kept").collect()
    assert {r.lang for r in got} == {"", "en", perplexity.NO_LANGUAGE}
    assert sorted(r.doc_id for r in quality.passing(docs).collect()) == sorted(r.doc_id for r in got)


def test_quality_rules_of_nothing(spark):
    empty = table(spark, [])
    assert quality.quality_rules(empty).count() == 0 and quality.passing(empty).count() == 0
    blank = table(spark, [(1, None, None, None), (2, "", "en", "s")])
    assert [r.kept for r in quality.quality_rules(blank).collect()] == [False, False]


def test_languages_beyond_the_limit_of_one_task(spark):
    docs = table(spark, documents())
    arrays = perplexity.hash_arrays(perplexity.kneser_ney(perplexity.gram_counts(docs)))
    groups = [langs for langs, _ in perplexity.scorers(arrays, limit=20_000)]
    assert len(groups) > 1 and sorted(sum(groups, [])) == ["de", "en", "fr", "und"]


def test_unseen_text_backs_off(spark):
    texts = [prose(300, i) for i in range(4)]
    docs = table(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    (_, scorer), = perplexity.scorers(perplexity.hash_arrays(perplexity.kneser_ney(perplexity.gram_counts(docs))))
    plain = plain_model(texts)
    for text in ("Quite another text, with new parts!", "%%% zzz 123", "re"):
        assert abs(scorer.perplexities("en", [text])[0] / plain(text) - 1) < 1e-3


def test_secrets(spark):
    draw = random.Random(4)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(draw.choice(alphabet) for _ in range(44)) for _ in range(12)]
    rows = documents() + [
        (100, 'é password = "abcdefgh1" token=short SECRET:ApiKey=zzzzzzzzzz x', "en", "s"),
        (101, "AKIA1234567890ABCD AKIAAKIA AKIAXYZ", "en", "s"),
        (102, "token=secret:abcdefghij " + "0123456789abcdef" * 2 + " " + "0123456789abcdef" * 2 + "z", "en", "s"),
        (103, "plain Zzzzzzzzzzzzzzzzzzzzzzzzzzzzzz1zzzzzzzzzzzzzzzzz text", "en", "s"),
    ] + [(110 + i, f"see {k} there", "en", "s") for i, k in enumerate(keys)]
    got = secrets.scan(table(spark, rows)).collect()
    assert len(got) == len(rows)
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    wanted = Counter()
    for doc_id, text, *_ in rows:
        t = text or ""
        found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 8]
        found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
        line = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))
        kinds = Counter(k for _, k, _ in found)
        wanted[doc_id, kinds[0], kinds[1], kinds[2], hashlib.sha256(line.encode()).hexdigest()] += 1
        for r in got:
            if r.doc_id == doc_id and doc_id not in (None, 70):
                assert ",".join(x for x in r.spans.split(",") if not x.startswith("random")) == line
    assert wanted == Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got)
    spans = {r.doc_id: r.spans for r in got}
    assert all(spans[110 + i] == "random:4:48" for i in range(12))
    assert spans[103] == "" and secrets.scan(table(spark, [])).count() == 0


def test_token_counts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    draw = random.Random(5)
    bits = list("aAsStrevlmd'  \n\t\r1²é中😀.!<|>-_’\x1c\x85") + ["'s", "'re", "'ll", " '", "<|endoftext|>", "     ", "====", "ing"]
    rows = documents() + [(200 + i, "".join(draw.choice(bits) for _ in range(draw.randrange(60))), "en", "s") for i in range(400)]
    rows += [(900, "<|endoftext|>" * 3 + " ", "en", "s"), (901, "a" * 5000 + " " * 5000, "en", "s")]
    got = token_counts.token_counts(table(spark, rows), path).collect()
    assert Counter(map(tuple, got)) == Counter(
        (i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024)
        for i, t, *_ in rows)
    assert token_counts.token_counts(table(spark, []), path).count() == 0


def test_character_classes_are_those_of_the_library():
    table_ = token_counts.character_classes()
    pre = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).pre_tokenizer
    draw = random.Random(6)
    for cp in [*range(32, 0x600), *(draw.randrange(0x600, 0x30000) for _ in range(3000))]:
        if 0xD800 <= cp < 0xE000:
            continue
        c = chr(cp)
        joins = [len(pre.pre_tokenize_str(x + c)) == 1 for x in ("b", "7", "%")]
        kind = table_[cp]
        assert joins == [token_counts.LETTER <= kind <= token_counts.E, kind == token_counts.NUMBER,
                         kind in (token_counts.OTHER, token_counts.QUOTE)], hex(cp)


def test_the_transducer_forgets_and_goes_on(monkeypatch):
    monkeypatch.setattr(token_counts, "TRANSITIONS", 64)
    path = public_tokenizers.path("byte_bpe_50k.json")
    counter = token_counts.PartCounter(__import__("json").load(open(path, encoding="utf-8")))
    library = Tokenizer.from_file(path)
    texts = [prose(200, i) for i in range(5)]
    for text in texts:
        assert token_counts.count_tokens([text], counter) == [len(library.encode(text).ids)]


def test_long_parts_are_composed_from_chunks():
    path = public_tokenizers.path("byte_bpe_50k.json")
    counter, library = token_counts.part_counter(path), Tokenizer.from_file(path)
    draw = random.Random(12)
    texts = ["a" * 400_000, "é" * 5000, "=" * 9000, "ab" * 4000, " " * 30_000, "-=" * 3000 + "x", "the" * 30_000]
    texts += ["".join(draw.choice("aeinorst") for _ in range(n)) for n in (2047, 2048, 2049, 4097, 50_000)]
    start = time.perf_counter()
    got = token_counts.count_tokens(texts, counter)
    assert time.perf_counter() - start < 20
    assert got == [len(library.encode(t).ids) for t in texts]


def distance_within(item: str, text: str) -> int:
    before = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        now = [i]
        for j, d in enumerate(text, 1):
            now.append(min(before[j - 1] + (c != d), before[j] + 1, now[-1] + 1))
        before = now
    return min(before)


def folded(text: str) -> str:
    return re.sub(r"[ \t\n\x0b\f\r]+", " ", text).lower()


def test_decontamination(spark):
    draw = random.Random(8)
    items = [(i, prose(25 + i, 500 + i)) for i in range(8)] + [(8, "too short"), (9, None), (None, prose(30, 600)), (3, prose(28, 503))]
    rows = documents()
    for i in range(24):
        text = list(items[i % 8][1].upper() if i % 3 == 0 else items[i % 8][1])
        for _ in range(int(len(text) * (0.0, 0.05, 0.09, 0.13)[i % 4])):
            at = draw.randrange(len(text))
            text[at:at + draw.randrange(2)] = draw.choice("qzx")
        rows.append((300 + i, prose(20, 700 + i) + "".join(text) + " " + prose(20, 800 + i), "en", "s"))
    rows += [(400, "the " * 3000, "en", "s"), (401, items[0][1], "en", "s"), (402, items[0][1][: len(items[0][1]) // 2], "en", "s")]
    docs, benchmark = table(spark, rows), spark.createDataFrame([(*x, 1) for x in items], "item_id bigint, text string, start int")
    got = decontamination.contaminated(docs, benchmark).collect()
    own = decontamination.indexes([x for x in items if x[1]], decontamination.EDIT_RATE)
    wanted = Counter()
    for doc_id, text, *_ in rows:
        if doc_id is None or doc_id < 300:
            continue
        for item_id, codes, edits in (x for index in own for x in zip(index.ids, index.items, index.edits)):
            d = distance_within("".join(map(chr, codes)), folded(text))
            if d <= edits:
                wanted[doc_id, item_id, d] += 1
    assert wanted == Counter((r.doc_id, r.item_id, r.distance) for r in got) and len(wanted) >= 18
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        if r.distance == 0:
            item = folded(dict((i, t) for i, t in items if i != 3).get(r.item_id) or items[3][1]).strip()
            assert r.item_id == 3 or folded(texts[r.doc_id][r.start:r.end]).strip() == item
    blocks = decontamination.contaminated(docs, benchmark, block_chars=300).collect()
    assert Counter(map(tuple, blocks)) == Counter(map(tuple, got))
    bad = {r.doc_id for r in got}
    clean = decontamination.decontaminated(docs, benchmark)
    assert clean.columns == docs.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(r[0] for r in rows if r[0] not in bad)
    assert decontamination.contaminated(table(spark, []), benchmark).count() == 0
    assert decontamination.decontaminated(docs, benchmark.limit(0)).count() == len(rows)
    assert decontamination.contaminated(docs, benchmark.limit(0)).count() == 0


def plain_matches(items: list[tuple[int, str]], text: str) -> set[tuple[int, int]]:
    return {(i, d) for i, t in items if folded(t).strip()
            and (d := distance_within(folded(t).strip(), folded(text))) <= int(len(folded(t).strip()) * 0.1)}


def found_matches(items: list[tuple[int, str]], text: str) -> set[tuple[int, int]]:
    table_ = decontamination.fold_table()
    return {(index.ids[no], d) for index in decontamination.indexes(items, 0.1)
            for (_, no), (d, *_) in decontamination.matches([text], index, index.bitmap(), table_).items()}


def test_items_of_any_length_are_found_with_the_whole_budget():
    draw = random.Random(31)
    for size in (1, 2, 3, 5, 9, 10, 12, 19, 20, 29, 39, 40, 43, 44, 50, 52, 54, 55, 60):
        for trial in range(6):
            item = (prose(40, 100 * size + trial).replace("\n", " "))[:size].strip() or "a"
            changed = list(item)
            for at in draw.sample(range(len(item)), int(len(item) * 0.1)):
                changed[at] = draw.choice("QZX#")
            text = prose(30, size + trial) + "".join(changed) + prose(30, size + trial + 1)
            got = found_matches([(1, item), (2, "   "), (3, "")], text)
            assert got == plain_matches([(1, item)], text) and got, (item, changed)


def test_repeated_grams_are_counted_in_slices(monkeypatch):
    items = [(1, "ab" * 60), (2, "ab" * 50 + prose(10, 3)), (3, prose(30, 4)), (4, "a" * 30)]
    texts = ["ab" * 700, "a" * 500, prose(40, 5) + items[2][1] + "ab" * 100 + items[1][1]]
    whole = [found_matches(items, t) for t in texts]
    monkeypatch.setattr(decontamination, "LISTED", 50)
    monkeypatch.setattr(decontamination, "REGION_CHARS", 200)
    assert [found_matches(items, t) for t in texts] == whole == [plain_matches(items, t) for t in texts]


def scripts() -> list[tuple]:
    """Texts whose letters were one symbol, in two halves: words of one script, and those letters in any order."""
    draw = random.Random(11)
    letters = [chr(0x4E00 + 32 * i) for i in range(40)]
    own = ["".join(draw.choice(letters) for _ in range(2)) for _ in range(30)]
    usual = [(i, " ".join(draw.choice(own) for _ in range(60)), "zh", "s") for i in range(60)]
    return usual + [(100, " ".join(draw.choice(letters) + draw.choice(letters) for _ in range(60)), "zh", "s")]


def test_code_points_beyond_ascii_are_symbols_of_their_own(spark):
    symbols = perplexity.symbol_table().tolist()
    assert sorted(symbols[128:]) == list(range(32, perplexity.SYMBOLS)) and set(symbols[:128]) == set(range(32))
    rows = scripts()
    got = {r.doc_id: r for r in quality.quality_rules(table(spark, rows)).collect()}
    plain = plain_model([r[1] for r in rows])
    assert all(abs(got[i].perplexity / plain(t) - 1) < 1e-4 for i, t, _, _ in rows)
    assert not got[100].kept and all(got[i].kept for i in range(60))


def test_a_model_beyond_one_task_is_split(spark):
    rows = [r for r in documents() if r[0] != 60] + scripts()
    docs = table(spark, rows)
    whole, split = ([(r.doc_id, r.lang, r.n_words, r.n_repeat_words, r.kept, r.perplexity and round(r.perplexity, 4))
                     for r in quality.quality_rules(docs, limit=limit).collect()] for limit in (1 << 28, 20_000))
    assert Counter(whole) == Counter(split)
    assert Counter(map(str, quality.passing(docs, limit=20_000).collect())) == Counter(
        map(str, quality.passing(docs).collect()))


def test_more_symbols_than_packed_numbers_hold():
    texts = ["".join(map(chr, range(0x20, 0xD800))) + "".join(map(chr, range(0x10000, 0x18000))), None, "", "ab ab"]
    lead, gram, which, sizes = perplexity.grams(texts)
    wanted, symbols = [], perplexity.symbol_table().tolist()
    for text in texts:
        seq = [0] * 3 + [symbols[ord(c)] for c in text or ""]
        wanted += [(seq[i], seq[i + 1] << 42 | seq[i + 2] << 21 | seq[i + 3]) for i in range(len(seq) - 3)]
    assert list(zip(lead[which].tolist(), gram[which].tolist(), strict=True)) == wanted
    assert sizes.tolist() == [len(t or "") for t in texts]

"""Small tables: nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import zlib
from collections import Counter

import pytest

from farsight.llm import decontam, exact, language, licenses, lines, lm, mixing, near_dups, prefix_tokens, toxicity

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
LONG = " ".join(WORDS[(i * i + i // 7) % 20] + str(i % 977) for i in range(60_000))
ODD = [(1, None), (2, ""), (3, "   \n "), (4, "one"), (4, "one"), (None, "two words"), (None, None), (5, LONG), (6, LONG)]


def test_exact_groups(table):
    found = exact.exact_groups(table([*ODD, (7, "one "), (8, LONG + "x")])).collect()
    assert len(found) == 11
    groups = Counter((row["keep_id"], row["group_size"]) for row in found)
    assert groups == {(2, 3): 3, (3, 1): 1, (4, 2): 2, (None, 1): 1, (6, 2): 2, (7, 1): 1, (8, 1): 1}
    assert Counter(row["keep_id"] for row in found if row["kept"]) == Counter([2, 3, 4, None, 6, 7, 8])
    assert exact.exact_groups(table([])).count() == 0


def test_mixing(table):
    rows = [(i, " ".join(["w"] * (i % 7)), None if i % 5 == 4 else f"s{i % 5}") for i in range(400)]
    rows += [(1000 + i, "w " * 2000, "s9") for i in range(3)] + [(None, None, "empty"), (7, "w w", "s2")]
    found = mixing.mix(table(rows)).collect()
    assert len(found) == len(rows)
    total = sum(row["size"] for row in found)
    by_source = {row["source"]: row for row in found}
    assert sum(row["target"] for row in by_source.values()) == pytest.approx(1.5 * total)
    for source, row in by_source.items():
        own = [r for r in found if r["source"] == source]
        assert row["source_size"] == sum(r["size"] for r in own)
        assert row["target"] <= 2 * row["source_size"]
        assert all(r["taken"] == r["size"] * r["copies"] and 0 <= r["copies"] <= 2 for r in own)
        assert abs(sum(r["taken"] for r in own) - row["target"]) <= max([r["size"] for r in own], default=0) * 2
    assert sorted(map(str, mixing.mix(table(rows)).collect())) == sorted(map(str, found))
    assert mixing.mix(table([])).count() == 0


def test_water_filling(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 10), ("c", 1000), (None, 50)], "source string, size long")
    found = {row["source"]: row["target"] for row in mixing.source_targets(sizes).collect()}
    # weights 3, 1, 2, 3; a, b and null are clamped, c has the rest
    assert found == {"a": 200.0, "b": 20.0, "c": 1420.0, None: 100.0}


def test_language(table, spark):
    rows = [(i, f"the {WORDS[i % 20]} of the house is {WORDS[i % 13]} and they were", "en") for i in range(40)]
    rows += [(100 + i, f"der {WORDS[i % 20]} und das haus ist {WORDS[i % 13]} nicht schön", "de") for i in range(40)]
    labelled = spark.createDataFrame(rows + [(999, None, "xx"), (998, "the", None)], "doc_id long, text string, lang string")
    learned = language.language_dictionaries(labelled)
    assert list(learned) == ["de", "en"]
    odd = table([*ODD, (20, "the house is old and they were of the"), (21, "und das haus ist nicht alt und schön"), (22, "12 34 !")])
    found = {row["doc_id"]: row for row in language.identify(odd, learned).collect()}
    assert (found[20]["lang_pred"], found[21]["lang_pred"]) == ("en", "de")
    assert not found[20]["rejected"] and 0 < found[20]["score"] <= 1
    for at in (1, 2, 3, 22):
        assert (found[at]["lang_pred"], found[at]["score"], found[at]["rejected"]) == ("und", 0.0, True)
    assert language.identify(odd, {}).filter("lang_pred = 'und'").count() == len(ODD) + 3
    assert language.identify(table([]), learned).count() == 0


def test_toxicity(table, spark):
    clean = [(f"the {WORDS[i % 20]} went to {WORDS[i % 17]} on a {WORDS[i % 11]}", 0) for i in range(60)]
    bad = [(f"you are a grumblefink {WORDS[i % 20]} went {WORDS[i % 11]}", 1) for i in range(20)]
    labelled = spark.createDataFrame([*clean, *bad, (None, 1), ("x", None)], "text string, toxic int")
    model = toxicity.fit_toxicity(labelled)
    assert any("grumblefink".startswith(term.stem) for term in model.terms)
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (6, None), (99, 1)], "doc_id long, toxic int")
    got = toxicity.labelled_texts(table(ODD), labels).collect()
    assert sorted((row["text"][:3], row["toxic"]) for row in got) == [(LONG[:3], 0), ("one", 1), ("one", 1)]
    assert toxicity.labelled_texts(table(ODD), labels, most=0).count() == 0
    rows = table([*ODD, (20, "a grumblefink"), (21, "a grumblefimk"), (22, "nice alpha"), (23, 'he said "grumblefink" is a word')])
    score = {row["doc_id"]: row["score"] for row in toxicity.score_toxicity(rows, model).collect()}
    assert score[20] > 0.5 and score[21] > score[22] and score[23] < score[20]
    assert score[1] == score[2] == score[22] < 0.3
    assert toxicity.score_toxicity(table([]), model).count() == 0
    assert toxicity.fit_toxicity(labelled.filter("toxic = 0")).weights == (0.0,) * len(toxicity.FEATURES)


@pytest.mark.parametrize("word,stem,open_,edits", [
    ("worthless", "worthless", False, 0), ("worthles", "worthless", False, 1), ("wxrthlesss", "worthless", False, 2),
    ("worthy", "worthless", False, None), ("loweichaft", "lowei", True, 0), ("lwei", "lowei", True, None), ("idiot", "idiots", False, 1),
])
def test_automaton(word, stem, open_, edits):
    found = toxicity.LexiconMatcher((toxicity.Term(stem, open_, 1.0),)).match(word)
    assert (None if found is None else found[1]) == edits


def test_token_counts(table):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["", "it's  we'll\n\n x", "a <|endoftext|> b  <|endoftext|>", "Ünïcödé 漢字 12345 !!!", "tab\t\tand  spaces   ", LONG[:3000]]
    found = prefix_tokens.token_counts(table(list(enumerate(texts))), prefixes=True, limit=5).collect()
    count = lambda text: len(library.encode(text, add_special_tokens=False).ids)
    for row in found:
        text = texts[row["doc_id"]]
        assert row["n_tokens"] == count(text) and row["n_bytes"] == len(text.encode())
        assert row["over_limit"] == (count(text) > 5)
        if len(text) < 1000:
            assert row["prefix_counts"] == [count(text[:k]) for k in range(len(text) + 1)]
            assert row["fits"] == max(k for k in range(len(text) + 1) if count(text[:k]) <= 5)
    assert prefix_tokens.token_counts(table(ODD)).count() == len(ODD)


def shingles(text):
    words = text.encode().lower().split()
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def alike(a, b):
    both = sum((a & b).values())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def brute_classes(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and (alike(sets[a], sets[b]) >= 0.8 or dict(rows)[a] == dict(rows)[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in sets}


def near_rows():
    base = [f"{WORDS[(7 * i) % 20]}{i}" for i in range(60)]
    rows = [(0, " ".join(base)), (1, " ".join(base).upper()), (2, " ".join(base))]
    for k in range(1, 25):  # a chain: each close to the next, the ends far apart, many in the same buckets
        rows.append((10 + k, " ".join(base[2 * k :] + [f"new{j}" for j in range(2 * k)])))
    rows += [(100 + k, " ".join(base[:20] + [f"own{k}x{j}" for j in range(30)])) for k in range(30)]
    return [*rows, (200, "short text"), (201, "short text"), (202, "short  Text"), (203, "a a a a a a a a"), (204, "a a a a a")]


def test_near_groups(table):
    rows = near_rows()
    found = {row["doc_id"]: row["class_id"] for row in near_dups.near_groups(table(rows)).collect()}
    assert found == brute_classes(rows)
    assert near_dups.keep_one(table(rows)).count() == len(set(found.values()))
    assert near_dups.near_groups(table([])).count() == 0


def test_near_groups_of_odd_rows(table):
    found = near_dups.near_groups(table(ODD)).collect()
    assert len(found) == len(ODD) and sum(row["kept"] for row in found) == 7
    assert near_dups.keep_one(table(ODD)).columns == table(ODD).columns


def test_signatures_are_unbiased():
    import numpy as np

    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    a, b = rng.integers(1, 9, 60), rng.integers(1, 9, 60)
    got = near_dups.bag_minhash(np.repeat([0, 1], 60), np.tile(hashes, 2), np.concatenate([a, b]), 2, 4000)
    wanted = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((got[0] == got[1]).mean() - wanted) < 0.03


def brute_lines(rows):
    """Texts without repeated lines, for tables without nulls."""
    import regex
    import xxhash

    def norm(line):
        whole, core = line.lower().strip(lines.BLANKS), line.lower().strip(lines.ENDS)
        return core if not core or len(core) >= max(20, 0.8 * len(whole)) else whole

    def print_of(line):
        words = regex.split(r"[^\p{L}]+", line)
        long = [w for w in words if len(w) >= 4]
        words = long if len(long) >= 8 else words
        hashes = [xxhash.xxh64_intdigest(w, seed=42) for w in words]
        return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = _next(row, i, x, b)
        return row[-1]

    def _next(row, i, x, b):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        return new

    different = {norm(line) for _, text in rows for line in text.split("\n")} - {""}
    root = {line: line for line in different}

    def find(line):
        while root[line] != line:
            line = root[line]
        return line

    fuzzy = sorted(line for line in different if len(line) >= 20)
    prints = {line: print_of(line) for line in fuzzy}
    for a in fuzzy:
        for b in fuzzy:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                if edits(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9):
                    root[find(a)] = find(b)
    seen, out = set(), {}
    for i, text in sorted(rows):
        left = []
        for line in text.split("\n"):
            group = find(norm(line)) if norm(line) else None
            if group is None or group not in seen:
                left.append(line)
            seen.add(group)
        out[i] = "\n".join(left)
    return out


def line_rows():
    body = " ".join(f"{w}{v}" for w in WORDS for v in ("able", "ing", "ment"))
    rows = [(1, f"{body} end\nunique first line here\n\n--"), (2, f"{body.upper()} END.\nsomething else entirely different"), (3, f"{body} ende\nab")]
    rows += [(10 + k, f"{body} {k}\nab\nown line number {WORDS[k]} with more words {WORDS[k + 1]}") for k in range(12)]
    return [*rows, (40, "ab"), (41, ""), (42, "--\n--\nAB!")]


def test_lines(table):
    rows = line_rows()
    found = {row["doc_id"]: row["text"] for row in lines.dedup_lines(table(rows)).collect()}
    assert found == brute_lines(rows)


def test_short_lines_keep_digits_and_signs(table):
    rows = [(1, "Chapter 1\nTotal: 15\nC++"), (2, "Chapter 2\nTotal: 20\nC#"), (3, "  chapter 2\nx 1234567890123456789012")]
    rows += [(4, "x 9999999999999999999999"), (5, "- The same words in a longer line, page 7"), (6, "the same words in a longer line, page 12.")]
    found = {row["doc_id"]: row["text"] for row in lines.dedup_lines(table(rows)).collect()}
    assert found == brute_lines(rows)
    assert found[2] == rows[1][1] and found[3] == "x 1234567890123456789012" and found[4] and found[6] == ""


def test_clashing_and_dotted_names(spark):
    df = spark.createDataFrame([(1, "a b c d", "s"), (2, "a b c d", None)], "doc_id long, text string, source string")
    names = "row row_gone gone draw mixed_source draw_ __draw __source limit need whole stays first"
    df = df.selectExpr("*", *(f"'{n}' AS {n}" for n in names.split()), "'x' AS `with.dot`")
    assert [r["row_gone"] for r in lines.dedup_lines(df).collect()] == ["row_gone"] * 2
    found = mixing.mix(df).collect()
    assert all(r["draw"] == "draw" and r["mixed_source"] == "mixed_source" and r["with.dot"] == "x" for r in found)


def test_only_results_are_left_in_the_shared_folder(spark, table):
    import pathlib

    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    assert lines.dedup_lines(table(line_rows())).count() and near_dups.near_groups(table(near_rows())).count()
    left = sorted(p.name.rsplit("-", 1)[0] for p in set(shared.iterdir()) - before)
    assert left == ["lines-to-drop", "near-classes"]


def test_lines_of_odd_rows(table):
    found = lines.dedup_lines(table(ODD)).collect()
    assert len(found) == len(ODD)
    texts = [(row["doc_id"], row["text"], row["n_lines"], row["n_dropped"]) for row in found if row["doc_id"] != 5]
    assert (1, None, 0, 0) in texts and (2, "", 1, 0) in texts and (3, "   \n ", 2, 0) in texts
    assert (6, "", 1, 1) in texts and sorted(t[1] for t in texts if t[0] == 4) == ["", "one"]
    assert lines.dedup_lines(table([])).count() == 0


def test_contamination(table, spark):
    items = [(1, " ".join(WORDS)), (2, "one two three"), (3, None), (4, ""), (5, "lone"), (6, " ".join(WORDS * 9)), (7, " ".join(WORDS))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    odd = [*ODD, (20, "x " * 7 + " ".join(WORDS).upper() + " y"), (21, " ".join(WORDS[2:]) + " y z"), (22, " ".join(WORDS[8:]))]
    odd += [(23, "a one two three b"), (24, "one two three"), (25, "z lone z"), (26, "q " * 3 + " ".join(WORDS * 9)), (20, " ".join(WORDS))]
    found = {(r["doc_id"], r["item_id"], round(r["similarity"], 3), r["start"]) for r in decontam.contamination(table(odd), benchmark).collect()}
    close = alike(shingles(" ".join(WORDS)), shingles(" ".join(WORDS[2:] + ["y", "z"])))
    assert close < 0.8
    assert found == {
        (20, 1, 1.0, 7), (20, 7, 1.0, 7), (20, 1, 1.0, 0), (20, 7, 1.0, 0), (23, 2, 1.0, 1), (24, 2, 1.0, 0), (25, 5, 1.0, 1),
        (26, 6, 1.0, 3), (26, 1, 1.0, 3), (26, 7, 1.0, 3),
    }
    kept = {row["doc_id"] for row in decontam.clean(table(odd), benchmark).collect()}
    assert kept == {1, 2, 3, 4, None, 5, 6, 21, 22}
    assert decontam.contamination(table([]), benchmark).count() == 0
    assert decontam.contamination(table(odd), benchmark.filter("item_id = 3")).count() == 0


def test_contamination_of_edited_passages(table, spark):
    """Windows with words lost at either end, against brute force."""
    items = [(k, " ".join(f"{w}{k}" for w in WORDS + WORDS[::-1])) for k in range(20)]
    docs = []
    for k, (_, text) in enumerate(items):
        words = text.split()
        cut = k % 5
        docs.append((k, " ".join(["pre"] * k + ["q"] * cut + words[cut:] + ["post"] * 3)))
    wanted = set()
    for i, text in docs:
        words = text.split()
        for j, item in items:
            size = len(item.split())
            best = max((alike(shingles(item), shingles(" ".join(words[s : s + size]))) for s in range(len(words) - size + 1)), default=0)
            if best >= 0.8:
                wanted.add((i, j))
    found = decontam.contamination(table(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == wanted


def test_licenses(table):
    mit = "Released under the MIT License."
    text = licenses.TEMPLATES["BSD-text"]
    rows = [*ODD, (20, f"x\n{mit}\ny"), (21, mit.upper()), (22, "released under the bsd license"), (23, f"a b {text} c"), (20, "z"), (24, " ".join(text.split()[:8]))]
    found = {(r["doc_id"], r["license"], r["containment"]) for r in licenses.scan_licenses(table(rows)).collect()}
    assert found == {(20, "MIT", 1.0), (21, "MIT", 1.0), (23, "BSD-text", 1.0)}
    assert licenses.scan_licenses(table([])).count() == 0
    with pytest.raises(ValueError):
        licenses.scan_licenses(table(rows), templates={"short": "too short"})


def test_lm_scores(table):
    import math
    import re

    from pyspark.sql import functions as F

    rows = [*ODD, *((100 + i, " ".join(WORDS[(i + j * j) % 20] for j in range(30))) for i in range(60))]
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    found = lm.score_texts(table(rows), held).collect()
    assert len(found) == len(rows)
    tokens = lambda text: [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w] + [None]
    is_held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, text in rows if not is_held(i) for w in tokens(text))
    n, v = sum(counts.values()), len(counts)
    wanted = Counter()
    for i, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        wanted[i, is_held(i), len(own), sum(counts[w] > 0 for w in own), n, round(base, 4)] += 1
    got = Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in found)
    assert got == wanted
    assert all(r["score"] < 0 for r in found)
    own = [r for r in found if r["doc_id"] is not None and r["doc_id"] >= 100 and r["held_out"]]
    assert sum(r["score"] for r in own) > sum(r["base_score"] for r in own)
    assert lm.score_texts(table([]), held).count() == 0


def test_lm_is_a_distribution():
    import numpy as np

    rng = np.random.default_rng(2)
    model = lm.Model(rng.integers(0, lm.CLUSTERS, lm.ENDINGS), np.zeros(lm.CLASSES), rng.normal(size=(lm.FEATURE_ROWS, lm.CLASSES)).astype(np.float32))
    types = (rng.integers(0, lm.ENDINGS, 500) * 16 + rng.integers(0, 10, 500)).astype(np.uint16)
    types[::3] = 32768 + rng.integers(0, lm.HEADS, len(types[::3]))
    logs = model.log_probabilities(model.features(types, np.arange(500) % 50 == 0))
    assert np.allclose(np.exp(logs.astype(np.float64)).sum(axis=1), 1, atol=1e-4)

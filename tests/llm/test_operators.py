"""Each operator against a plain version: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clinweave.llm import simple8b
from clinweave.llm.byte_bpe import PrefixCoder, PrefixText, encode_decode
from clinweave.llm.decontaminate import ItemIndex, find_items
from clinweave.llm.exact_dedup import PatriciaTrie, drop_exact_duplicates, exact_duplicates
from clinweave.llm.near_dup import near_duplicates
from clinweave.llm.pii import EXAMPLES, added_spans, base_spans, labelled, personal_data, train
from clinweave.llm.substring_dedup import dedup_substrings
from clinweave.llm.token_counts import PreTokenTree, _counter, edited_counts, with_edits
from clinweave.llm.token_files import read_documents, write_tokens
from clinweave.llm.toxicity import Restorer, character_model, fit, toxicity
from clinweave.llm.url_filter import DigestArray, judge_urls
from clinweave.llm.vocab import default_path, load_ranks, load_tokenizer, split_pattern
from clinweave.llm.words import words_of

rnd = random.Random(7)
WORDS = [a + b for a in ("th", "er", "ing", "na", "So") for b in ("a", "en", "is.", "ou", "tion,")]


def prose(n: int) -> str:
    return " ".join(rnd.choice(WORDS) for _ in range(n))


LONG = prose(30_000)
BASE = [prose(n) for n in (3, 40, 90, 200, 400)]
TEXTS = [
    None, "", " \n\t", "one", "two words", *BASE, *BASE, LONG, BASE[4] + " and a bit more", BASE[4].upper(),
    BASE[3][:300] + " 9 " + BASE[3][300:], prose(20) + " " + BASE[2] + " " + prose(20), "a " * 500, "漢字 ß é  x", BASE[1],
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3 + 1, t, "x", i) for i, t in enumerate(TEXTS)] + [(4, "", "x", 0), (None, BASE[0], "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, kept int")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, score string, kept int")


def known(frame) -> dict:
    return {r["doc_id"]: r for r in frame.collect() if r["doc_id"] is not None}


def by_id() -> dict:
    return {i * 3 + 1: t or "" for i, t in enumerate(TEXTS)}


def shingles(text: str, size: int) -> set:
    words = text.encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set()


def test_near_duplicates(docs, none):
    found, texts = known(near_duplicates(docs, 3, 85)), by_id()
    sets = {i: shingles(t, 3) for i, t in texts.items()}
    group = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * both >= 85 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    for i in sets:
        row = found[i]
        assert (row["n_shingles"], row["component_id"], row["kept"]) == (len(sets[i]), group[i], group[i] == i)
    assert near_duplicates(docs, 3, 85).where("doc_id is null and kept and component_id is null").count() == 1
    assert near_duplicates(none).count() == 0


def test_near_duplicates_in_a_crowd_below_the_threshold(spark):
    """Pages of one template, alike but not enough, with pairs among them that are: every pair is found, no other."""
    words, dice = [f"w{k}" for k in range(200)], random.Random(3)

    def changed(page: list[str], places: list[int], name: str) -> list[str]:
        page = list(page)
        for place in places:
            page[place] = f"{name}x{place}"
        return page

    texts = {}
    for k in range(900):
        places = sorted(dice.sample(range(39), 8))
        page = changed(words, [5 * place for place in places[::2]], f"p{k}")
        texts[1000 + (k * 7919) % 900] = " ".join(page)
        if k % 6 == 0:
            texts[5000 + (k * 4999) % 900] = " ".join(changed(page, [5 * place for place in places[1::2]], f"q{k}"))
    sets, group = {i: shingles(t, 5) for i, t in texts.items()}, {i: i for i in texts}
    for a in sorted(sets):
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {i: new if g == old else g for i, g in group.items()} if old != new else group
    assert sum(group[i] != i for i in group) >= 100 and len(set(group.values())) > 400
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = known(near_duplicates(docs, 5, 80))
    wrong = {i for i, row in found.items() if row["component_id"] != group[i]}
    assert not wrong and len(found) == len(texts)


@pytest.mark.parametrize("budget", [300, 10**8])
def test_exact_duplicates(docs, none, budget):
    found, texts = exact_duplicates(docs, "largest", budget), by_id()
    assert found.count() == len(TEXTS) + 2
    for i, row in known(found).items():
        same = [j for j, t in texts.items() if t == texts[i]]
        size = len(same) + (texts[i] == "") + (texts[i] == BASE[0])
        assert (row["keep_id"], row["group_size"], row["kept"]) == (max(same), size, i == max(same))
        assert row["text_sha256"] == hashlib.sha256(texts[i].encode()).hexdigest()
    assert exact_duplicates(none).count() == 0
    assert drop_exact_duplicates(docs).columns == docs.columns


def test_trie_holds_all_and_gives_up_subtrees():
    trie, held = PatriciaTrie(), {}
    for k in range(3000):
        key = bytes(rnd.choices(b"abc", k=rnd.randrange(9)))
        trie.insert(key, k, k, 1)
        low, high, n = held.get(key, (k, k, 0))
        held[key] = (min(low, k), max(high, k), n + 1)
    gone = trie.give_up()
    assert dict([*trie.entries(), *gone]) == held and gone


def test_token_counts(docs, none):
    count, cut = _counter(default_path("byte_bpe_50k.tiktoken")), split_pattern()
    parts = ["the", " ", "  ", "\n", "'s", "ing", "é", "12", "!", "漢", " x"]
    for _ in range(150):
        text = "".join(rnd.choices(parts, k=rnd.randrange(300)))
        tree = PreTokenTree(text, count, cut)
        for _ in range(3):
            start = rnd.randrange(len(text) + 1)
            end, new = min(len(text), start + rnd.randrange(9)), "".join(rnd.choices(parts, k=rnd.randrange(4)))
            tree.edit(start, end, new)
            text = text[:start] + new + text[end:]
            words = cut.findall(text)
            assert [w for b in tree.blocks for w in b] == words and tree.tokens == sum(map(count.__getitem__, words))
    rows = known(edited_counts(with_edits(docs, "[0-9]+", "<N>")))
    assert rows[1]["n_tokens"] == 0 and any(r["n_edits"] for r in rows.values())
    assert edited_counts(with_edits(none, "x", "y")).count() == 0
    odd = docs.limit(1).withColumn("edits", F.expr("array(named_struct('start', 5L, 'end', 2L, 'new', 'x'), null)"))
    assert [r["n_edits"] for r in edited_counts(odd).collect()] == [0]


def test_token_files(spark, docs, none, tmp_path):
    write_tokens(docs, f"file://{tmp_path}/t", block_ids=500)
    tokenizer, start = load_tokenizer(default_path("byte_bpe_50k.json")), 0
    rows = sorted(read_documents(spark, f"file://{tmp_path}/t").collect(), key=lambda r: r["start"])
    expected = [(None, BASE[0])] + sorted([*by_id().items(), (4, "")])
    assert [r["doc_id"] for r in rows] == [i for i, _ in expected]
    for row, (_, text) in zip(rows, expected, strict=True):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    write_tokens(none, f"file://{tmp_path}/n")
    assert read_documents(spark, f"file://{tmp_path}/n", ids=True).count() == 0


def test_simple8b_round_trip():
    rng = np.random.default_rng(1)
    for k in range(300):
        values = rng.integers(0, 1 << int(rng.integers(1, 64)), rng.integers(0, 600), dtype=np.uint64)
        values[rng.random(len(values)) < (k % 3) / 3] = 0
        assert (simple8b.unpack(*simple8b.pack(values)) == values).all()


def test_personal_data(spark, docs, none):
    model = train(labelled(spark))
    text = "x a.b@c.de, 1.2.3.4 1.2.3.400 or 4539148803436467 or +1 (212) 555-0148 @ a@b"
    assert [(k, text[a:b]) for k, a, b in base_spans(text)] == [
        ("email", "a.b@c.de"), ("ip", "1.2.3.4"), ("card", "4539148803436467"), ("phone", "+1 (212) 555-0148")
    ]
    plain = [e.replace("[", "").replace("]", "") for e in EXAMPLES]
    assert added_spans(plain, model) == added_spans(plain, model, whole=True)
    assert added_spans(["there were 23 of them in 1994"], model) == [[]]
    assert [k for k, _, _ in added_spans(["set password=7f3e91aa02bc5d here"], model)[0]] == ["secret"]
    assert all(not r["spans"] for r in personal_data(docs.where("text is null or text = ''"), model).collect())
    assert personal_data(none, model).count() == 0


@pytest.mark.parametrize("window", [50, 7])
def test_substring_dedup(docs, none, window):
    words = {i: t.encode().split() for i, t in by_id().items()}
    first: dict = {}
    for i, w in sorted(words.items()):
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    for i, row in known(dedup_substrings(docs, window, bits=20)).items():
        w = words[i]
        gone = {k + j for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < i for j in range(window)}
        assert (row["n_words"], row["n_removed"]) == (len(w), len(gone))
        assert row["kept_text"].encode() == b" ".join(x for k, x in enumerate(w) if k not in gone)
    assert dedup_substrings(none).count() == 0


def test_url_filter(spark, tmp_path):
    rules = [("allow", "org/"), ("block", "b.org/x")]
    rows = [(1, "http://A.b.org/x1?q"), (2, "http://b.org"), (3, None), (4, "no scheme"), (5, "http://m.bad.net/p#t"), (5, "s://bad.netx/"),
            (None, "x://y://z/"), (7, "http://bad.net?x/")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    listed = spark.createDataFrame([("bad.net",), (None,), ("",), ("bad.net",)], "entry string")
    wanted = [(1, "a.b.org", "/x1", "b.org/x", "block"), (2, "b.org", "", None, "allow"), (3, "", "", None, "allow"),
              (4, "", "", None, "allow"), (5, "m.bad.net", "/p", None, "block"), (5, "bad.netx", "/", None, "allow"),
              (None, "y:", "//z/", None, "allow"), (7, "bad.net", "", None, "block")]
    for size in (10**6, 0):
        assert sorted(map(str, map(tuple, judge_urls(pages, rules, listed, size).collect()))) == sorted(map(str, wanted))
    assert judge_urls(pages.limit(0), rules, []).count() == 0
    DigestArray.write(str(tmp_path / "d"), ["a", "b", "c"], digest=lambda _: 7)  # every digest collides
    assert DigestArray(str(tmp_path / "d"), digest=lambda _: 7).holds([b"b", b"d"]).tolist() == [True, False]


def test_byte_bpe(docs, none):
    import public_tokenizers
    import tiktoken

    ranks = load_ranks(default_path("byte_bpe_multi_50k.tiktoken"))
    coder = PrefixCoder(ranks)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = by_id()
    for i, row in known(encode_decode(docs)).items():
        assert np.frombuffer(row["token_ids"], "<u4").tolist() == library.encode_ordinary(texts[i])
        assert bytes(row["decoded"]) == texts[i].encode()
    for _ in range(40):
        text = bytes(rnd.choices(b"thering \xc3\xa9xq", k=50))
        start = rnd.randrange(50)
        whole = PrefixText(coder, text)
        whole.edit(start, min(50, start + 3), b"ed")
        whole.append(b"zing")
        text = text[:start] + b"ed" + text[min(50, start + 3) :] + b"zing"
        assert whole.table == coder.last_tokens(text) and whole.ids == [ranks[t] for t in coder.merge(text)]
    assert encode_decode(none, digest=True).count() == 0


def test_toxicity(spark, none):
    bad = ["stupid", "idiot", "trash"]
    rows = [(i, prose(30) + (f" {rnd.choice(bad)} you {rnd.choice(bad)}" if i % 5 == 0 else "") + " " + prose(9)) for i in range(400)]
    docs = spark.createDataFrame([*rows, (None, "stupid idiot"), (1000, None), (1001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = fit(docs, labels)
    scored = {r["doc_id"]: r for r in toxicity(docs.withColumn("score", F.lit("clash")), model).collect()}
    assert all(scored[i]["predicted"] == int(i % 5 == 0) for i in range(300, 400))
    assert scored[None]["predicted"] == 1 and 0 <= scored[1000]["score"] == scored[1001]["score"] < 0.5
    restore = Restorer(character_model(docs)).restore
    assert [restore(w) for w in ("stup1d", "i d i o t", "tr@sh", "stuuupid")] == ["stupid", "idiot", "trash", "stupid"]
    flat = fit(docs, labels.limit(0))
    assert toxicity(none, flat).count() == 0 and flat.score(set()) == 0.5


def test_token_files_follow_the_library_on_added_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\n y", "<|endoftext> no mark", "plain"]
    write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), f"file://{tmp_path}/marks")
    plain = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    found = {r["doc_id"]: list(r["ids"]) for r in read_documents(spark, f"file://{tmp_path}/marks", ids=True).collect()}
    assert found == {k: [*plain.encode(t, add_special_tokens=False).ids, 2] for k, t in enumerate(texts)}


def test_spaced_words_are_told_apart(spark):
    said = ["you are such a stupid idiot and a liar", "a stupid trash idiot", "an idiot, such a trash", "stupid, idiot. a liar"]
    texts = [(k, said[k % 4] + " " + prose(20)) for k in range(200)]
    restore = Restorer(character_model(spark.createDataFrame(texts, "doc_id long, text string"))).restore
    assert restore("such a i d i o t") == "such a idiot"
    assert restore("s t u p i d i d i o t") == "stupid idiot"
    assert restore("such a s.t.u.p.i.d.t.r.a.s.h") == "such a stupid trash"
    assert restore(" ".join("stupididiot" * 30)).split() == ["stupid", "idiot"] * 30  # over 200 letters
    assert restore("s" * 199 + "tuuu" + "pid") == "stupid"


def test_repeated_items_reach_the_driver_once(spark, docs, monkeypatch):
    held, make = [], ItemIndex.__init__

    def index(self, rows, percent):
        held.append(len(rows))
        make(self, rows, percent)

    monkeypatch.setattr(ItemIndex, "__init__", index)
    items = [(5, BASE[3])] * 60 + [(6, BASE[4]), (7, BASE[3])]
    found = known(find_items(docs, spark.createDataFrame(items, "item_id long, text string"), block_bytes=10**6))
    assert sum(held) == 3
    assert {m["item_id"] for m in found[3 * TEXTS.index(BASE[3]) + 1]["matches"]} == {5, 7}


@pytest.mark.parametrize("block", [10**6, 2000])
def test_find_items(spark, docs, none, block):
    words = LONG.split()
    items = [(0, BASE[1]), (0, BASE[1]), (1, " ".join(words[9000:9030])), (2, "two words"), (3, None), (4, "   "), (None, "x y z"),
             (5, " ".join(words[100:120]) + " q r s t u v w x"), (6, prose(40)), (7, "not there")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = known(find_items(docs, benchmark, block_bytes=block))
    for i, text in by_id().items():
        own, want = shingles(text, 5), set()
        all_words = text.encode().lower().split()
        for item, passage in items:
            parts = (passage or "").encode().lower().split()
            if item is None or not parts:
                continue
            if len(parts) < 5:
                inside = any(all_words[k : k + len(parts)] == parts for k in range(len(all_words)))
            else:
                inside = 100 * len(shingles(passage, 5) & own) >= 80 * len(shingles(passage, 5))
            want |= {item} if inside else set()
        assert {m["item_id"] for m in found[i]["matches"]} == want
    assert find_items(none, benchmark).count() == 0 and find_items(docs, benchmark.limit(0)).where("contaminated").count() == 0


def test_repetitive_long_words_are_told_apart(spark):
    """Two words of 2,048 letters that a polynomial modulo 2**64 cannot tell apart, whatever its odd base."""
    one, two = "x", "y"
    for _ in range(11):
        one, two = one + two, two + one
    hashes = words_of(pa.array([f"{one} {two}", "q" * 63, "q" * 64, "q" * 65, "q" * 128, "ab ba"])).hashes()
    assert len(set(hashes.tolist())) == len(hashes)
    tail = " ".join(f"w{k}" for k in range(60))
    rows = [(1, one), (2, two), (3, f"{one} {tail}"), (4, f"{two} {tail[:-4]}"), (5, " ".join([one] * 60)), (6, " ".join([two] * 60))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = known(near_duplicates(docs, 3, 85))
    assert {i: r["component_id"] for i, r in found.items()} == {1: 1, 2: 2, 3: 3, 4: 3, 5: 5, 6: 6}
    assert {i: r["n_removed"] for i, r in known(dedup_substrings(docs)).items()} == {1: 0, 2: 0, 3: 0, 4: 59, 5: 0, 6: 0}
    items = spark.createDataFrame([(1, one), (2, " ".join([two] * 8))], "item_id bigint, text string")
    matches = {r["doc_id"]: sorted(m["item_id"] for m in r["matches"]) for r in find_items(docs, items).collect()}
    assert matches == {1: [1], 2: [], 3: [1], 4: [], 5: [1], 6: [2]}

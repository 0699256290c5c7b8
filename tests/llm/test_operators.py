"""Every operator against a brute-force version on the smallest tables, and on odd rows."""

import collections
import hashlib
import re
import struct
import zlib

import corpus_pipeline
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tradelake.llm import chat, common, extraction, langid, neardup, packing, pieces, quality, repeats, sharding, winnowing, words

ROOT = "/root/testdata/sf0.001"
QUERIES = queries()
LONG = "Lorem ipsum dolor sit amet consectetur. " * 3000
# Nulls, empty and very long texts, ties and repeated rows; columns whose names clash with those the operators add.
ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, LONG, "en", "b"), (5, LONG, "en", "b"),
    (6, "one two", "de", "b"), (6, "one two", "de", "b"), (7, "one two", "de", "c"), (None, "no id here", "de", "c"),
    (8, "éà \U0001f600 x", "fr", "c"), (9, "1234 !!", "fr", "d"), (10, "x" * 5000, "fr", "d"), (11, "</s><|done|> <\\ a", "en", "d"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ODD, SCHEMA)
    clash = {c: F.lit(7) for c in ("_Added", "_ID", "_text_key", "_Spans", "_host", "_Rate", "__id", "__host", "key", "n", "id", "kept", "range", "ghost", "row", "words", "count", "shard", "slot")}
    return rows.withColumns(clash).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return sorted(spark.read.parquet(f"{ROOT}/documents.parquet").collect(), key=lambda r: r.doc_id)


def by_id(rows):
    return {r[0]: r for r in rows}


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# 1 packing


def check_packing(pieces_found, texts, ids_of, length):
    of_doc, of_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces_found:
        of_doc[p.doc_id].append(p)
        of_sequence[p.sequence_id].append((p.offset, p.length))
    assert set(of_doc) == set(texts)
    for key, text in texts.items():
        ids, at = [*ids_of(text), 2], 0
        for p in sorted(of_doc[key], key=lambda p: p.start):
            raw = struct.pack(f"<{p.length}I", *ids[at : at + p.length])
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(raw))
            at += p.length
        assert at == len(ids)
    for sequence, parts in of_sequence.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == length or sequence == max(of_sequence)
    assert sorted(of_sequence) == list(range(len(of_sequence)))


@pytest.fixture(scope="module")
def word_ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def word_spec():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def test_packing(spark, docs, word_ids):
    check_packing(QUERIES["op1_hilbert_packing"](spark, ROOT).collect(), {d.doc_id: d.text for d in docs}, word_ids, 4096)


def test_packing_odd(spark, odd, empty, word_ids):
    unique = odd.where("doc_id IS NULL OR doc_id <> 6")
    check_packing(packing.pack(unique, word_spec(), 64).collect(), {r.doc_id: r.text for r in unique.collect()}, word_ids, 64)
    twice = packing.pack(odd.where("doc_id = 6"), word_spec()).collect()
    assert [(p.sequence_id, p.offset, p.length) for p in sorted(twice, key=lambda p: p.offset)] == [(0, 0, 3), (0, 3, 3)]
    assert packing.pack(empty, word_spec()).count() == 0


def test_word_ids_of_odd_texts(word_ids):
    import numpy as np

    tokenizer = words.WordTokenizer(word_spec())
    for text in ["it's we'll dog'don'T", "a\x1cb\x85c　d", "İstanbul ŉ ΣΑΣ é é", "THES!!\r\nx\t\ty 123", "ﬁ Å", "x" * 500, "ſt K <|endoftext|>"]:
        assert np.frombuffer(tokenizer.encode([text])[0], "<u2").tolist() == word_ids(text)


def test_hilbert_neighbours_touch():
    import numpy as np

    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    place = packing.hilbert(grid, 3)
    assert sorted(place) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(place)], axis=0)).sum(1) == 1).all()


# 2 winnowing


def test_winnowing(spark, docs):
    found = by_id(QUERIES["op2_winnowing"](spark, ROOT).collect())
    assert len(found) == len(docs)
    for i, d in enumerate(docs):
        n, h = len(d.text), len(d.text) // 2
        edited = d.text[: n - h] + docs[(i + 1) % len(docs)].text[:h]
        r = found[d.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha(edited))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    same = collections.defaultdict(set)
    for d in docs:
        same[d.text].add(found[d.doc_id].fingerprint)
    assert all(len(prints) == 1 for prints in same.values())
    assert len({found[d.doc_id].fingerprint for d in docs}) == len(same)


def test_winnowing_chooses_rightmost_minimum(spark):
    texts = ["a b c d e f g h i j", "a a a a a a a a a", "a b", "", "q " * 40 + "z"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    codes = {r.w: r.h for r in spark.sql("SELECT w, xxhash64(w) AS h FROM VALUES " + ", ".join(f"('{w}')" for w in "abcdefghijqz") + " t(w)").collect()}
    grams = {}
    for text in texts:
        w = [codes[x] for x in text.split()]
        for i in range(max(len(w) - 3, 1) if w else 0):
            grams[tuple(w[i : i + 4])] = None
    for g in grams:
        grams[g] = spark.sql(f"SELECT xxhash64({', '.join(f'{x}L' if x >= -(2**63) + 1 else str(x) for x in g)})").first()[0]
    for r in winnowing.fingerprints(rows).collect():
        w = [codes[x] for x in texts[r.doc_id].split()]
        h = [grams[tuple(w[i : i + 4])] for i in range(max(len(w) - 3, 1) if w else 0)]
        want = []
        for i in range(max(len(h) - 3, 1) if h else 0):
            window = range(i, min(i + 4, len(h)))
            at = max(j for j in window if h[j] == min(h[k] for k in window))
            if at not in want:
                want.append(at)
        assert (r.positions, r.hashes) == (want, [h[i] for i in want])


def test_winnowing_match_guarantee(spark):
    passage = "alpha beta gamma delta epsilon zeta eta"  # k + window - 1 words
    rows = spark.createDataFrame([(1, f"x y {passage} z"), (2, f"q {passage} r s t u")], "doc_id long, text string")
    one, two = winnowing.fingerprints(rows).orderBy("doc_id").collect()
    assert set(one.hashes) & set(two.hashes)


def test_winnowing_match_guarantee_without_spaces(spark):
    passage = "いろはにほへとちりぬるを\U0001f600わかよたれそつねな"  # SPAN + k + window - 2 characters
    assert len(passage) == winnowing.SPAN + winnowing.K + winnowing.WINDOW - 2
    rows = [(i, "あいうえおかきくけこさしすせそた"[:i] + passage + "んやゆよ" * (i % 3)) for i in range(17)]
    found = winnowing.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(set(a.hashes) & set(b.hashes) for a in found for b in found)


def test_winnowing_units(spark):
    def units(text):
        runs = text.split()
        return [r[i : i + 16] for r in runs for i in range(max(len(r) - 15, 1))]

    texts = ["a bc　de\u00a0f", "x" * 15 + " " + "y" * 16 + "\u2003" + "0123456789abcdefg", "\U0001f600" * 18 + "z", "", " ", "\n".join("ab" * n for n in range(12))]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in rows.select("doc_id", F.regexp_extract_all("text", F.lit(winnowing._UNIT)).alias("units")).collect():
        assert r.units == units(texts[r.doc_id])


def test_winnowing_odd(odd, empty):
    rows = winnowing.edit_and_compare(odd).collect()
    assert len(rows) == len(ODD) and sorted(r.n_chars for r in rows) == sorted(len(t or "") for _, t, *_ in ODD)
    assert winnowing.edit_and_compare(empty).count() == 0
    lone = winnowing.edit_and_compare(odd.where("doc_id = 11")).first()
    assert lone.near_next == 1.0


# 3 sharding


def check_shards(rows, sizes):
    places = collections.defaultdict(list)
    for r in rows:
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == sizes


def expected_sizes(rows):
    raw = lambda t: (t or "").encode()
    return collections.Counter((r[0], len(raw(r[1])) + 8, zlib.crc32(raw(r[1]))) for r in rows)


def test_sharding(spark, docs):
    rows = QUERIES["op3_virtual_slots"](spark, ROOT).collect()
    check_shards(rows, expected_sizes(docs))
    load = collections.Counter()
    for r in rows:
        load[r.shard] += r.size
    assert set(load) == set(range(24)) and max(load.values()) - min(load.values()) <= max(r.size for r in rows)


def test_sharding_odd(spark, odd, empty, tmp_path):
    check_shards(sharding.shard(odd, 3, str(tmp_path / "a")).collect(), expected_sizes(ODD))
    assert sharding.shard(empty, 3, str(tmp_path / "b")).count() == 0
    assert sharding.load_map(spark, str(tmp_path / "b")).count() == sharding.SLOTS


def test_a_new_shard_takes_slots_only_for_itself(spark, tmp_path):
    path = str(tmp_path / "map")
    rows = sharding.records(spark.read.parquet(f"{ROOT}/documents.parquet"))
    totals = sharding.slot_totals(rows).cache()
    sharding.save_map(sharding.first_map(totals, 5), path)
    old = {r.virtual_slot: r.shard for r in sharding.load_map(spark, path).collect()}
    sharding.save_map(sharding.grow_map(sharding.load_map(spark, path), totals, 5), path)
    assert {r.virtual_slot: r.shard for r in sharding.load_map(spark, path, 1).collect()} == old
    new = {r.virtual_slot: r.shard for r in sharding.load_map(spark, path).collect()}
    assert len(new) == sharding.SLOTS and {new[s] for s in new if new[s] != old[s]} == {5}
    load = collections.Counter()
    for r in totals.collect():
        load[new[r.virtual_slot]] += r.bytes
    assert max(load.values()) < 1.2 * sum(load.values()) / 6


# 4 SentencePiece


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def model():
    return pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))


def expected_pieces(library, text):
    ids = library.encode(text or "")
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))


def test_pieces(spark, docs, library):
    found = by_id(QUERIES["op4_sentencepiece"](spark, ROOT).collect())
    assert {k: tuple(r[1:]) for k, r in found.items()} == {d.doc_id: expected_pieces(library, d.text) for d in docs}


def test_pieces_odd(odd, empty, library, model):
    rows, name = pieces.digests(odd, model)
    for r in rows.collect():
        assert tuple(r[name]) == expected_pieces(library, r.text)
    assert pieces.digests(empty, model)[0].count() == 0


ODD_TEXTS = ["", " ", "  a  b ", "a\nb", "▁x y", "\x00a", "é̀ ﬁ", "<s>", "　x", "日本 語 \U0001f600", "\n\na\n \nb\n", "▁ ▁", "a" * 300, " " * 50 + "x", "<0x0A>", "\r\n a;\r"]


def test_pieces_round_trip_and_spans(library, model):
    own = pieces.Model(model)
    for text in ODD_TEXTS:
        ids, begins, ends = own.encode(text)
        assert ids == library.encode(text) and own.decode(ids) == library.decode(ids)
        raw = text.encode()
        for i, (a, b) in zip(ids, zip(begins, ends, strict=True), strict=True):
            if not own.first_byte <= i < own.first_byte + 256:
                surface = raw[a:b].decode().replace(" ", "▁")
                assert own.names[i] in (surface, f"▁{surface}")
        assert not ids or (begins[0] == 0 and ends[-1] == len(raw))
        assert begins == sorted(begins)


def test_digests_are_made_from_checked_spans(model, monkeypatch):
    own, texts = pieces.Model(model), ["plain words, then\nmore", "日本 x", *ODD_TEXTS]
    own.digests(texts)
    normalise = own.normalise
    monkeypatch.setattr(own, "normalise", lambda text: (lambda n, b, e: (n, b, e + 1))(*normalise(text)))
    for text in filter(None, texts):
        with pytest.raises(ValueError):
            own.digests([text])


def test_spans_of_whole_table(spark, library, model):
    own = pieces.Model(model)
    rows, name = pieces.encode(spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "text"), model)
    for r in rows.collect():
        raw, (ids, begins, ends) = (r.text or "").encode(), r[name]
        assert ids == library.encode(r.text or "")
        for n, (i, a, b) in enumerate(zip(ids, begins, ends, strict=True)):
            if not own.first_byte <= i < own.first_byte + 256:
                assert own.names[i] == ("" if n or not own.names[i].startswith("▁") else "▁") + raw[a:b].decode().replace(" ", "▁")


def test_character_map_takes_longest_prefix(library):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    # A map as the library compiles it, for its own rule set, read back here.
    normalizer = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(normalizer.serialized_model_proto())
    charmap = pieces.CharacterMap(proto.normalizer_spec.precompiled_charsmap)
    assert charmap.units
    changed = 0
    for text in ["ﬁ", "①", "\u212b", "A\u030a", "ｶﾞ", "㍿", "½", "xﬁy①", "e\u0301e"]:
        raw, at, out = text.encode(), 0, []
        while at < len(raw):
            size, new = charmap.longest(raw, at)
            changed += new is not None
            size = size or len(raw[at:].decode()[0].encode())
            out.append((raw[at : at + size] if new is None else new).decode())
            at += size
        assert "".join(out) == normalizer.normalize(text).removeprefix("▁")
    assert changed >= 9
    assert charmap.longest(b"abc", 0) == (0, None)


# 5 language


def test_language(spark, docs):
    found = by_id(QUERIES["op5_langid"](spark, ROOT).collect())
    out = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 3 == 1]
    assert {k for k, r in found.items() if r.held_out} == {d.doc_id for d in out}
    assert sum(found[d.doc_id].lang_pred == d.lang for d in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_odd(odd, empty):
    rows, name = langid.predict(odd, langid.fit(odd))
    found = rows.collect()
    assert len(found) == len(ODD)
    for r in found:
        assert (r[name].lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert langid.predict(empty, langid.fit(empty))[0].count() == 0
    rows, name = langid.predict(odd, langid.fit(empty))
    assert {r[name].lang_pred for r in rows.collect()} == {"und"}


@pytest.mark.parametrize("lang", [None, "und"])
def test_language_stage_keeps_all_texts_with_letters(spark, odd, lang):
    rows = odd.withColumn("lang", F.lit(lang).cast("string"))
    kept = corpus_pipeline.identify_language(spark, rows, ROOT).collect()
    want = [(i, t) for i, t, *_ in ODD if any(c.isalpha() for c in t or "")]
    assert collections.Counter((r.doc_id, r.text) for r in kept) == collections.Counter(want)


def test_rare_languages_and_long_words_are_learned(spark):
    word = lambda i: hashlib.sha256(str(i).encode()).hexdigest().translate(str.maketrans("0123456789", "ghijklmnop"))
    rows = [(i, " ".join(word(7 * i + j)[:8] for j in range(7)), "big") for i in range(2000)]
    rows += [(3000 + i, "zuq vuqz quvz", "rare") for i in range(6)] + [(4000 + i, word(9) * 2 + "rstuv", "long") for i in range(6)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 50, 1000)
    assert model["langs"] == ["big", "long", "rare"]
    assert {"zuq", "vuqz", "quvz"} <= set(model["words"]) and {"rstuv", "stuv>"} <= set(model["grams"])
    assert {len(g) for g in model["grams"]} == {1, 2, 3, 4, 5}
    scorer = langid.Scorer(model)
    assert scorer.text("vuqz zuq")[0] == "rare" and scorer.text(word(9) * 2 + "rstuv")[0] == "long"
    long = word(9) * 2 + "rstuv"
    assert list(scorer.word(long)) == model["word_logs"][model["words"].index("#" + sha(long))].tolist()


def test_language_model_holds_plain_counts(spark):
    """Words and n-grams of at least one in `rarest` of a language, with logs of their counts, as plain Python has them."""
    import math
    import random

    import regex

    draw = random.Random(4)
    parts = ["the", "of", "der", "Haus", "मैं", "हिन्दी", "été", "x" * 70, "a1b", "können", "\u0301z"]
    rows = [(i, " ".join(draw.choice(parts[: 4 + i % 8]) for _ in range(draw.randrange(30))), draw.choice(["en", "de", "hi", None])) for i in range(200)]
    rows += [(500, None, "en"), (501, "", "de"), (502, "12 !", "fr")]
    for rarest in (10**6, 12):
        model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rarest=rarest)
        words, grams = collections.Counter(), collections.Counter()
        for i, text, lang in rows:
            if lang is None or zlib.crc32(str(i).encode()) % 3 == 1:
                continue
            for w in regex.findall(r"\p{L}[\p{L}\p{M}]*", (text or "").lower()):
                words[w if len(w) <= 64 else "#" + sha(w), lang] += 1
                p = f"<{w}>"
                grams.update((p[j : j + n], lang) for n in range(1, 6) for j in range(len(p) - n + 1))
        langs = sorted({x for _, x in words})
        assert model["langs"] == langs and "हिन्दी" in {w for w, _ in words}
        for counted, keys, logs in ((words, model["words"], model["word_logs"]), (grams, model["grams"], model["gram_logs"])):
            totals = {x: sum(n for (_, y), n in counted.items() if x == y) for x in langs}
            want = sorted({k for (k, x), n in counted.items() if n * rarest >= totals[x]})
            assert keys == want and (rarest == 12) == (len(want) < len({k for k, _ in counted}))
            for x, column in zip(langs, logs.T, strict=True):
                whole = sum(counted[k, x] for k in want) + langid.SMOOTH * len(want)
                assert column.tolist() == pytest.approx([math.log((counted[k, x] + langid.SMOOTH) / whole) for k in want])


def test_unseen_words_fall_back_to_longest_known_grams():
    import numpy as np

    model = {"langs": ["a", "b"], "words": ["ja"], "word_logs": np.array([[-1.0, -2.0]]), "grams": ["sch", "s", "x"], "gram_logs": np.array([[-1.0, -5.0], [-5.0, -1.0], [-3.0, -1.0]])}
    scorer = langid.Scorer(model)
    assert scorer.text("ja")[0] == "a" and scorer.text("schs")[0] == "a" and scorer.text("xs")[0] == "b"


# 6 near duplicates


def shingle_set(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def expected_groups(texts, size, percent):
    sets = {k: shingle_set(t, size) for k, t in texts.items()}
    parent = {k: k for k in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {k: (len(sets[k]), top(k), top(k) == k) for k in keys}


def groups(rows):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows.collect()}


def test_near_duplicates(spark, docs):
    assert groups(QUERIES["op6_lsh_forest"](spark, ROOT)) == expected_groups({d.doc_id: d.text for d in docs}, 3, 85)


def test_near_duplicates_odd(odd, empty):
    found = neardup.near_duplicates(odd)
    want = expected_groups({k: t for k, t, *_ in ODD if k is not None}, 5, 80)
    assert groups(found.where("doc_id IS NOT NULL")) == want
    assert found.count() == len(ODD) and found.where("doc_id IS NULL").first().kept
    assert neardup.near_duplicates(empty).count() == 0


def test_an_id_on_several_texts(spark):
    """Each text has its own links, and none goes because another text of its id does."""
    base = [f"w{i}" for i in range(60)]
    x, other, y = " ".join(base), " ".join([*base[:59], "last"]), " ".join(f"v{i}" for i in range(50))
    near_y = y + " more"
    rows = [(3, x), (5, x), (5, y), (5, y), (9, near_y), (12, other), (13, "alone"), (13, "by itself"), (14, None), (None, x)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, _GONE_id int").repartition(3)
    found = {(r.doc_id, r.n_shingles): (r.class_id, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect()}
    assert found[5, 56] == (3, 3, False) and found[5, 46] == (5, 5, True)
    assert found[9, 47] == (9, 5, False) and found[12, 56] == (12, 3, False) and found[14, 0] == (14, 14, True)
    kept = neardup.keep_first(docs)
    assert kept.columns == docs.columns
    want = [(3, x, 0), (5, y, 2), (5, y, 3), (13, "alone", 6), (13, "by itself", 7), (14, None, 8), (None, x, 9)]
    assert sorted(map(tuple, kept.collect()), key=lambda r: r[2]) == want
    # The smallest id is on two texts that are each near another document.
    both = spark.createDataFrame([(1, x), (1, y), (2, other), (4, near_y)], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in neardup.near_duplicates(both).collect()) == [(1, 1), (1, 1), (2, 1), (4, 1)]
    assert sorted(r.text for r in neardup.keep_first(both).collect()) == sorted([x, y])


def test_keep_first_of_odd_rows(odd, empty):
    kept = neardup.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 6, 8, 9, 10, 11]
    assert neardup.keep_first(empty).count() == 0


def test_large_regions(spark):
    """Many variants of one text: those of a common base are near it, not each other; two bases share a part."""
    import random

    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(500)]
    bases = [[draw.choice(vocabulary) for _ in range(120)] for _ in range(2)]
    bases.append(bases[0][:100] + bases[1][:20])
    texts = {}
    for i in range(150):
        t = list(bases[i % 3])
        for _ in range(draw.choice([0, 1, 1, 2, 3])):
            t[draw.randrange(len(t))] = draw.choice(vocabulary)
        texts[1000 - i] = " ".join(t)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for like in (neardup.Likeness(), neardup.Likeness(3, 85, 24)):
        assert groups(neardup.near_duplicates(rows, like)) == expected_groups(texts, like.words, like.percent)


def test_common_shingles_are_counted_per_set():
    import numpy as np

    draw = np.random.default_rng(8)
    sets = [np.unique(draw.integers(0, 9000, n).astype(np.uint64)) for n in (1, 40, 3000, 9000, 5000)]
    order = np.argsort(np.concatenate(sets), kind="stable")
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])[order]
    for one in sets:
        both = neardup.common_shingles(one, np.concatenate(sets)[order], owner, len(sets))
        assert both.tolist() == [len(np.intersect1d(one, x)) for x in sets]


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99)], "a long, b long")
    assert {r.node: r.component for r in neardup.components(edges).collect()} == {**{i: 0 for i in range(41)}, 99: 99, 100: 99}


# 7 quality


def expected_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    many, inside, seen, dup = collections.Counter(grams), set(), set(), 0
    for i, g in enumerate(grams):
        if many[g] > 1:
            inside.update(range(i, i + 5))
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", "".join(w))), dup, len(inside)


def fails(counts):
    return counts[0] < 10 or 100 * counts[4] > 20 * counts[0]


def test_quality(spark, docs):
    found = by_id(QUERIES["op7_host_rules"](spark, ROOT).collect())
    for d in docs:
        r, want = found[d.doc_id], expected_counts(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == fails(want) and r.kept == (not fails(want) and r.host_rate <= 0.5)


def test_quality_odd(odd, empty):
    rows, name = quality.judge(odd)
    found = rows.collect()
    assert len(found) == len(ODD) and rows.columns == [*odd.columns, name]
    for r in found:
        assert tuple(r[name])[:5] == expected_counts(r.text)
    assert quality.judge(empty)[0].count() == 0


def test_quality_writes_no_texts(spark, monkeypatch):
    """The query returns no text, so none is written with the counts."""
    written, write = [], quality.materialize
    monkeypatch.setattr(quality, "materialize", lambda df, name: written.append(df.columns) or write(df, name))
    QUERIES["op7_host_rules"](spark, ROOT)
    assert written and all("text" not in columns for columns in written)


def test_quality_keeps_what_is_asked_for(odd):
    """The verdicts are the same whatever is kept, also where the host's own column is not."""
    (whole, name), (some, other) = quality.judge(odd), quality.judge(odd, keep=["_host", "doc_id"])
    assert some.columns == ["doc_id", "_host", other]
    assert sorted(map(str, some.select("doc_id", f"{other}.*").collect())) == sorted(map(str, whole.select("doc_id", f"{name}.*").collect()))


def test_a_bad_host_goes_and_a_small_one_is_judged_by_the_prior(spark):
    rows = [(f"good{i}", j == 0) for i in range(8) for j in range(20)] + [("bad", j < 19) for j in range(20)] + [("tiny", True)]
    rates = {r.host: r.rate for r in quality.host_rates(spark.createDataFrame(rows, "host string, failed boolean")).collect()}
    raw = collections.defaultdict(list)
    for host, failed in rows:
        raw[host].append(failed)
    means = [sum(x) / len(x) for x in raw.values()]
    mean = sum(means) / len(means)
    weight = min(max(mean * (1 - mean) / (sum((m - mean) ** 2 for m in means) / len(means)) - 1, 2), 1000)
    for host, x in raw.items():
        assert rates[host] == pytest.approx((sum(x) + mean * weight) / (len(x) + weight))
    assert rates["bad"] > 0.5 > rates["good0"] and rates["tiny"] < 1


# 8 extraction


def test_extraction(spark):
    from tradelake.llm.dom import Page

    pages = by_id(spark.read.parquet(f"{ROOT}/pages.parquet").select("page_id", "html").collect())
    found = QUERIES["op8_boosted_dom"](spark, ROOT).collect()
    assert len(found) == len(pages)
    wrong = 0
    for r in found:
        page = Page(pages[r.page_id].html)
        keep = [False] * len(page.tags)
        for i in range(1, len(keep)):
            keep[i] = page.tags[i] == "article" or keep[page.parents[i]]
        wrong += r.text != page.text(keep)
        assert r.n_chars == len(r.text)
    assert wrong <= 0.02 * len(found)


BODY = "<p>Lorem ipsum dolor &amp; sit,\n amet.</p><p>Of.</p><h2>Part</h2><p>Sed do <a href='/q'>eiusmod</a> tempor."
TEXT = "Lorem ipsum dolor & sit, amet.\nOf.\nPart\nSed do eiusmod tempor."


def test_layouts_not_in_the_table(spark):
    trees = extraction.fit(spark.read.parquet(f"{ROOT}/pages.parquet"))
    holders = ['<div id="content">%s</div>', "<main>%s</main>", '<section class="entry-content">%s</section>', '<article class="post">%s</article>']
    around = (
        '<header><h1>Site</h1></header><div class="sidebar"><ul><li><a>one</a></li></ul></div><div class="cookie-banner"><p>We use cookies.</p></div>',
        '<div id="comments"><div class="comment"><p>Nice one, thanks!</p></div></div><form><label>Mail</label><input><button>Go</button></form><div class="footer">Copyright</div>',
    )
    rows = [(i, "u", f"<html><head><title>t</title></head><body>{around[0]}{h % BODY}{around[1]}</body></html>") for i, h in enumerate(holders)]
    rows += [(90, "u", None), (91, "u", ""), (92, "u", "<p unclosed <b"), (93, "u", rows[0][2]), (93, "u", rows[0][2])]
    found = extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), trees).collect()
    texts = collections.defaultdict(list)
    for r in found:
        texts[r.page_id].append(r.text)
    assert all(texts[i] == [TEXT] for i in range(4)) and texts[93] == [TEXT] * 2 and texts[90] == texts[91] == [""]


def test_extraction_of_nothing(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert extraction.extract(none, extraction.fit(none)).count() == 0


def test_no_kept_element_below_a_dropped_one():
    import numpy as np

    assert extraction.decode([-1, 0, 1, 1, 0], np.array([0.0, -1.0, 3.0, -2.0, -1.0])) == [True, True, True, False, False]
    assert extraction.decode([-1, 0, 1], np.array([0.0, -5.0, 3.0])) == [True, False, False]


# 9 repeats


def expected_kept(texts):
    raws = [(k, (t or "").encode()) for k, t in texts]
    many = collections.Counter(raw[i : i + 200] for _, raw in raws for i in range(len(raw) - 199))
    out = []
    for k, raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - 199):
            if many[raw[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((k, len(raw), sum(gone), spans, sha(kept)))
    return collections.Counter(out)


def removed(docs):
    rows, name = repeats.remove_repeats(docs, replace=False)
    return collections.Counter(tuple(r) for r in rows.select("doc_id", f"{name}.*").collect())


def test_repeats(spark, docs):
    found = collections.Counter(tuple(r) for r in QUERIES["op9_repeats"](spark, ROOT).collect())
    assert found == expected_kept([(d.doc_id, d.text) for d in docs])


def test_repeats_odd(odd, empty):
    assert removed(odd) == expected_kept([(k, t) for k, t, *_ in ODD])
    assert removed(empty) == collections.Counter()
    rows, name = repeats.remove_repeats(odd.withColumn("n_chars", F.length("text")))
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows.collect())
    assert rows.columns == [*odd.columns, "n_chars", name]


@pytest.mark.parametrize("group", [repeats.GROUP, 2, 1])
@pytest.mark.parametrize("segment", [repeats.SEGMENT, 300])
def test_repeats_of_periodic_texts(spark, monkeypatch, group, segment):
    import random

    monkeypatch.setattr(repeats, "GROUP", group)
    draw = random.Random(segment)
    parts = ["ab", "c", "abc ", "aa", "x y", "\n", "é", "\0"]
    bases = ["".join(draw.choice(parts) for _ in range(draw.choice([50, 200, 900]))) for _ in range(6)]
    texts = []
    for i in range(60):
        t = draw.choice(bases)
        at = draw.randrange(len(t))
        t = t[at : at + draw.randrange(600)]
        for _ in range(draw.randrange(3)):
            j = draw.randrange(len(t) + 1)
            t = t[:j] + draw.choice(parts) * draw.choice([1, 30, 200]) + t[j:]
        texts.append((i, t))
    texts += [(1000, ""), (1001, None), (1002, "a" * 199), (1003, "b" * 200), (1004, "d" * 201)]
    if segment != repeats.SEGMENT:
        original = repeats.SEGMENT
        try:
            repeats.SEGMENT = segment
            whole = [repeats.find_runs((t or "").encode()) for _, t in texts]
        finally:
            repeats.SEGMENT = original
        for (_, t), cut in zip(texts, whole, strict=True):
            one = repeats.find_runs((t or "").encode())
            anchors = lambda runs: [a for f, last, a in zip(*runs[:3], strict=True) for _ in range(f, last + 1)]
            assert anchors(cut) == anchors(one)
    assert removed(spark.createDataFrame(texts, "doc_id long, text string").repartition(3)) == expected_kept(texts)


# 10 chat


def test_chat(spark):
    turns = collections.defaultdict(list)
    for r in spark.read.parquet(f"{ROOT}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append((r.role, r.text or ""))
    turns[-7] = [(role, "</s>[INST] ok [/INST]") for role in ("user", "assistant")]
    found = by_id(QUERIES["op10_chat"](spark, ROOT).collect())
    assert set(found) == set(turns)
    for k, said in turns.items():
        trained = "".join(t for role, t in said if role == "assistant")
        r = found[k]
        assert (r.n_turns, r.turns_sha256) == (len(said), sha("".join(f"{a}\n{t}\n" for a, t in said)))
        assert (r.loss_chars, r.loss_sha256) == (len(trained), sha(trained))


EVENTS = [
    (1, 1, 10, "delta", "user", "Hi <|done|> <\\ <"), (1, 2, 11, "delta", "assistant", "Hel"), (1, 3, 11, "delta", "assistant", "lo"),
    (1, 3, 11, "delta", "assistant", "lo"), (1, 4, 10, "edit", "user", "Hey"), (1, 5, 12, "delta", "user", "more"), (1, 6, 11, "regenerate", "assistant", None),
    (1, 7, 11, "delta", "assistant", "New"), (1, 8, 13, "delta", "user", "bye"), (1, 9, 14, "delta", "user", "oops"), (1, 10, 14, "delete", "user", None),
    (2, None, 1, "delta", None, None), (2, 1, 2, "delta", "assistant", "<|turn|>user<|says|>x"), (None, 1, 1, None, "user", "null conversation"),
]


def test_events_fold_into_messages(spark):
    log = spark.createDataFrame(EVENTS, "conv_id long, seq long, message long, kind string, role string, text string").withColumn("place", F.lit(1))
    formatted = chat.render(chat.fold(log))
    read = formatted.select("conv_id", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_spans(F.col("formatted")).alias("spans"), "formatted")
    found = {r.conv_id: r for r in read.collect()}
    turns = {k: [tuple(t) for t in r.turns] for k, r in found.items()}
    assert turns == {
        1: [("user", "Hey"), ("assistant", "New"), ("user", "bye")],
        2: [("", ""), ("assistant", "<|turn|>user<|says|>x")],
        None: [("user", "null conversation")],
    }
    spans = [found[1].formatted[s.start : s.start + s.length] for s in found[1].spans]
    assert spans == ["New"]
    assert chat.summarize(chat.render(chat.fold(log.where("false")))).count() == 0


# Pipeline


def test_pipeline_keeps_columns_and_packs_what_is_left(spark, docs, tmp_path, word_ids):
    import corpus_pipeline

    at = spark.read.parquet(f"{ROOT}/documents.parquet")
    columns, kept = at.columns, []
    for i, (name, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, at, ROOT).write.parquet(str(tmp_path / str(i)))
        at = spark.read.parquet(str(tmp_path / str(i)))
        kept.append(at.collect())
        assert name == "packing" or at.columns == columns
    language, rules, near, cut, packed = kept
    assert {r.doc_id for r in language} == {d.doc_id for d in docs if any(c.isalpha() for c in d.text)}
    assert {r.doc_id for r in rules} <= {r.doc_id for r in language if not fails(expected_counts(r.text))}
    want = expected_groups({r.doc_id: r.text for r in rules}, 5, 80)
    assert {r.doc_id for r in near} == {k for k, (_, _, keep) in want.items() if keep}
    sizes = {k: n - gone for k, n, gone, _, _ in expected_kept([(r.doc_id, r.text) for r in near])}
    assert {r.doc_id: len(r.text.encode()) for r in cut} == sizes
    check_packing(packed, {r.doc_id: r.text for r in cut}, word_ids, 4096)


def test_operators_match_their_sql(spark):
    import compare
    from tradelake.llm.oracles import all_oracles

    db = compare.connect(ROOT)
    for name, sql in all_oracles().items():
        names, rows, inexact = compare.duck_rows(db, sql)
        assert (names, rows) == compare.spark_rows(QUERIES[name](spark, ROOT)) and not inexact


def test_shipping_twice_is_harmless(spark):
    common.ship_package(spark)
    common.ship_package(spark)

"""The operators with Python in them, against libraries, brute-force versions and edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from lectern.llm import components, host_paths, language_id, sentencepiece_codec, simhash, token_shards  # noqa: E402

SP, BPE = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "a", "a  b\t\nc", "\x1c x\x1f\x85 y", "🙂 x\n🙂 日本語", "x" * 20_000, "lorem ipsum, dolor. " * 2000]


def frame(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "clash") for i, t in zip(ids or range(len(texts)), texts)], "doc_id long, text string, fp string")


def random_texts(seed, n, letters):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]


# SentencePiece


def test_codec_is_the_library():
    import sentencepiece

    lib, own = sentencepiece.SentencePieceProcessor(model_file=SP), sentencepiece_codec.SentencePieceCodec(SP)
    texts = [*(t or "" for t in ODD), *(" " * k + s for k in range(60) for s in ("", "a", "the", "\n")), *random_texts(1, 4000, [*"abtheing  \n\té日ﬁ中x.,'12ñ", "▁", "🙂", "the", " and"])]
    for t in texts:
        ids = lib.encode(t)
        assert own.encode(t) == ids, t
        assert own.encode(t, add_end=True) == [*ids, 2] and own.decode(ids) == lib.decode(ids), t


def test_decode_broken_bytes_like_the_library():
    import sentencepiece

    lib, own = sentencepiece.SentencePieceProcessor(model_file=SP), sentencepiece_codec.SentencePieceCodec(SP)
    rng = random.Random(3)
    for _ in range(1500):
        ids = [rng.randrange(3, 32_000) if rng.random() < 0.6 else rng.randrange(3, 259) for _ in range(rng.randint(0, 10))]
        assert own.decode(ids) == lib.decode(ids), ids


def test_backtracking_alone_is_merging():
    """Without cuts and memory, so that whole texts go through the automaton."""
    own = sentencepiece_codec.SentencePieceCodec(SP)
    for t in random_texts(5, 1500, ["a", "b", "th", "e", "in", "g", "▁", "s", "er"]):
        assert not t or own._span(t) == own._merge(t)


def test_encode_documents(spark):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=SP)
    got = {r["doc_id"]: r for r in sentencepiece_codec.encode_documents(frame(spark, ODD, [*range(8), None]), SP).collect()}
    for i, t in zip([*range(8), None], ODD):
        ids = lib.encode(t or "", add_eos=True)
        assert got[i]["ids"] == ids and got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
    assert sentencepiece_codec.encode_documents(frame(spark, ["x"]).limit(0), SP).count() == 0
    many = frame(spark, [f"word {i} " * 3000 for i in range(60)]).withColumn("more", F.col("doc_id") * 7)  # more ids than are held at a time
    rows = sentencepiece_codec.encode_documents(many, SP, keep=("more",)).collect()
    assert sorted((r["doc_id"], r["more"]) for r in rows) == [(i, 7 * i) for i in range(60)] and all(r["ids"] == lib.encode(f"word {r['doc_id']} " * 3000, add_eos=True) for r in rows)


# token shards


def test_encoder_is_the_library():
    from tokenizers import Tokenizer

    lib, own = Tokenizer.from_file(BPE), token_shards.TextEncoder(BPE)
    words = [" ".join(t.split()) for t in random_texts(7, 3000, [*"aé,.;'1-( ", " ", " ", "the", "<|endoftext|>"])] + ["a b\nc d.\ne", "\n", "a\n\nb", "a \nb", "a\n b", "x, y.", "\x1fa b"]
    texts = [*(t or "" for t in ODD), *words, *random_texts(2, 6000, ["'s", "'t", " ", "  ", "\t", "\n", "\r\n", "\xa0", "\x85", "\x1c", "a", "bc", "é", "Ж", "日", "1", "½", ".", ",", "$$", "!?", "🙂", "ª", "'", "’", "<|endoftext|>"])]
    want = [[*lib.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    for step in (1, 7, len(texts)):
        for k in range(0, len(texts), step):
            ids, sizes = own.encode(pa.array(texts[k : k + step], pa.large_string()))
            assert ids.tolist() == sum(want[k : k + step], []) and sizes.tolist() == [*map(len, want[k : k + step])], texts[k : k + step][:1]


def test_encoder_forgets_and_stays_right(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_shards, "MEMORY", 60)
    monkeypatch.setattr(token_shards, "LONGEST", 7)
    lib, own = Tokenizer.from_file(BPE), token_shards.TextEncoder(BPE)
    rng = random.Random(4)
    for _ in range(40):
        texts = [" ".join("".join(rng.choices("abcé", k=rng.randint(1, 9))) + rng.choice(["", ",", ".", "9", "\nx"]) for _ in range(rng.randint(0, 30))) for _ in range(5)]
        ids, sizes = own.encode(pa.array(texts, pa.large_string()))
        want = [[*lib.encode(t, add_special_tokens=False).ids, 2] for t in texts]
        assert ids.tolist() == sum(want, []) and sizes.tolist() == [*map(len, want)]
        assert len(own.pieces) == len(own.length) == len(own.hits) and own.length.sum() == len(own.flat) and len(own.pieces) < 60 + 150


def test_shard_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    for n_docs, alphabet in ((0, 5), (1, 3), (40, 4), (300, 60), (50, 50_000)):
        docs = [np.append(rng.integers(0, alphabet, rng.integers(0, 400)), token_shards.END).astype(np.uint32) for _ in range(n_docs)]
        docs += docs[: n_docs // 2] + [np.array([7] * 999 + [2], np.uint32)]  # repeats
        ids = np.concatenate(docs)
        payload = token_shards.compress(ids, np.array([len(d) for d in docs]), 50_257)
        shard = token_shards.Shard(payload)
        assert (shard.ids() == ids).all() and all((shard.document(k) == d).all() for k, d in enumerate(docs))
        for _ in range(50):
            a, b = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
            assert (shard.read(a, b) == ids[a:b]).all()
        assert n_docs < 40 or len(payload) < 4 * len(ids) + 28 + 4 * len(docs) + len(ids)
    assert len(shard.left) >= 0 and len(token_shards.compress(np.tile(np.arange(9, dtype=np.uint32), 5000), np.array([45_000]), 50_257)) < 45_000


def test_shards_are_compressed_to_the_end():
    rng = np.random.default_rng(6)
    copies = np.tile(np.append(rng.integers(3, 40_000, 3000), token_shards.END), 300).astype(np.uint32)
    few = np.where(rng.random(60_000) < 0.02, token_shards.END, rng.zipf(1.3, 60_000) % 500 + 3).astype(np.uint32)
    short = np.tile(np.array([5, 6, token_shards.END], np.uint32), 4000)
    for ids in (copies, few, short, np.full(50_000, 9, np.uint32)):
        ends = np.flatnonzero(ids == token_shards.END)
        lengths = np.diff(np.concatenate(([0], ends + 1, [len(ids)])))
        payload = token_shards.compress(ids, lengths[lengths > 0], 50_257)
        shard = token_shards.Shard(payload)
        assert (shard.ids() == ids).all()
        texts = {s: shard._expand(np.array([s])) for s in np.unique(shard.seq).tolist()}
        assert all((t[:-1] != token_shards.END).all() for t in texts.values())  # no symbol spans documents
        before, counts = None, {}
        for s in shard.seq.tolist():
            if before is not None and texts[before][-1] != token_shards.END:
                counts[before, s] = counts.get((before, s), 0) + (counts.get("last") != (before, s) or before != s)
                counts["last"] = (before, s)
            else:
                counts["last"] = None
            before = s
        assert max((n for k, n in counts.items() if k != "last"), default=0) < token_shards.LEAST
        if ids is copies:
            assert len(payload) < 4 * len(ids) / 50


def test_written_documents(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(BPE)
    ids = [5, 3, 9, 1, 7, 7, 2, 4, 8]
    df = frame(spark, ODD, ids)
    got = {(r["doc_id"], r["start"]): r for r in token_shards.read_documents(spark, token_shards.write_shards(df, BPE, shard_ids=500)).collect()}
    at = 0
    for i, t in sorted(zip(ids, (t or "" for t in ODD))):
        tokens = [*lib.encode(t, add_special_tokens=False).ids, 2]
        r = got.pop((i, at))
        assert r["n_tokens"] == len(tokens) and r["ids_crc32"] == zlib.crc32(np.array(tokens, "<u4").tobytes())
        at += len(tokens)
    assert not got
    assert token_shards.read_documents(spark, token_shards.write_shards(df.limit(0), BPE)).count() == 0
    huge = 2**62 + 1  # beside a null
    nulls = token_shards.read_documents(spark, token_shards.write_shards(frame(spark, ["a", "b"], [None, huge]), BPE)).collect()
    assert sorted((r["start"], r["doc_id"]) for r in nulls) == [(0, None), (2, huge)]
    assert {r["doc_id"] for r in sentencepiece_codec.encode_documents(frame(spark, ["a", "b"], [None, huge]), SP).collect()} == {None, huge}


# SimHash


def slow_print(text):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def smallest_reachable(prints, ids):
    a, seen, out = np.array(prints, np.uint64), set(), {}
    for i in range(len(a)):
        if i in seen:
            continue
        todo, group = [i], {i}
        while todo:
            for j in np.flatnonzero(np.bitwise_count(a ^ a[todo.pop()]) <= 3).tolist():
                if j not in group:
                    group.add(j)
                    todo.append(j)
        seen |= group
        out.update(dict.fromkeys(group, min(ids[j] for j in group)))
    return [out[i] for i in range(len(a))]


def test_fingerprints_and_components(spark):
    rng = random.Random(6)
    base = [[f"w{rng.randrange(90)}" for _ in range(rng.randint(1, 300))] for _ in range(12)]
    texts = list(ODD)
    for words in base:
        for _ in range(5):
            w = list(words)
            if rng.random() < 0.8:
                w[rng.randrange(len(w))] = "Changed"
            texts.append(" ".join(w))
    ids = rng.sample(range(1000), len(texts))
    prints = [slow_print(t) for t in texts]
    got = {r["doc_id"]: r for r in simhash.assign_components(frame(spark, texts, ids)).collect()}
    assert [got[i]["fingerprint"] for i in ids] == [f"{p:016x}" for p in prints]
    want = smallest_reachable(prints, ids)
    assert [got[i]["component_id"] for i in ids] == want
    kept = simhash.drop_near_copies(frame(spark, texts, ids))
    assert {r["doc_id"] for r in kept.collect()} == set(want) and kept.columns == ["doc_id", "text", "fp"]


@pytest.mark.parametrize("big,near", [(4096, 32), (10, 4), (3, 2)])
def test_no_link_is_lost_at_any_level(spark, monkeypatch, big, near):
    monkeypatch.setattr(simhash, "BIG", big)
    monkeypatch.setattr(simhash, "NEAR", near)
    rng = random.Random(big)
    centres = [rng.getrandbits(64) for _ in range(3)]
    values = sorted({c ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 5))}) for c in centres for _ in range(120)} | {rng.getrandbits(64) for _ in range(50)})
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    table = {r["fp"]: r["component_id"] for r in simhash.component_table(spark.createDataFrame(list(enumerate(signed)), "_id long, fp long")).collect()}
    assert [table[s] for s in signed] == smallest_reachable(values, range(len(values)))


def test_simhash_edges(spark):
    assert simhash.assign_components(frame(spark, ["x"]).limit(0)).count() == 0
    rows = simhash.assign_components(frame(spark, [None, "", "same", "same", "same"], [3, None, 9, 9, None])).collect()
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in rows) == [("3", 3), ("9", 9), ("9", 9), ("None", 3), ("None", 9)]
    kept = simhash.drop_near_copies(frame(spark, ["same", "same", "same"], [9, 9, None])).collect()
    assert [r["doc_id"] for r in kept] == [9]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 200: 200, 201: 200}


# languages


def test_languages_on_held_out_documents(spark):
    rng = random.Random(4)
    make = {"aa": ("thing", "and", "over", "tion", "ing"), "bb": ("sche", "und", "ung", "ein", "keit"), "cc": ("eaux", "que", "ment", "elle", "oir")}
    rows = []
    for i in range(240):
        lang = rng.choice(list(make))
        rows.append((i, " ".join("".join(rng.choices(make[lang], k=rng.randint(1, 3))) for _ in range(40)) + ".", lang if i % 17 else None, lang))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, truth string").withColumn("score", F.lit("clash"))
    got = {r["doc_id"]: r for r in language_id.identify(df).collect()}
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= got[i]["score"] <= 1 for i in got)
    held = [i for i in got if got[i]["held_out"]]
    assert sum(got[i]["lang_pred"] == rows[i][3] for i in held) >= 0.98 * len(held) > 20
    model = language_id.LanguageModel([tuple(r) for r in language_id.learn(df).collect()])
    assert model.predict("undungeinkeitschekeit")[0] == "bb" and model.predict("eauxellequemoirque")[0] == "cc"  # unseen words
    assert model.predict(None) == model.predict("") == model.predict("12 ²½ !?") == ("und", 0.0)
    long = " ".join(t for _, t, _, truth in rows if truth == "aa") * 30
    assert model.predict(long)[0] == "aa"


def test_scores_of_languages_against_loops(spark, monkeypatch):
    """The docstring's rule by plain loops over the counts."""
    import math

    rng = random.Random(21)
    make = {"aa": "abcde", "bb": "bcdfé", "cc": "xyzae"}
    rows = [(i, " ".join("".join(rng.choices(make[l], k=rng.randint(1, 5))) for _ in range(rng.randint(1, 30))), l) for i in range(90) for l in [rng.choice([*make])]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learnt = [tuple(r) for r in language_id.learn(df, words=40, grams=25).collect()]
    counts = {(l, n, g): c for l, n, g, c, _ in learnt}
    total = {(l, n): t for l, n, _, _, t in learnt}
    size = {n: len({g for _, m, g, *_ in learnt if m == n}) for n in range(5)}
    log = lambda l, n, g: math.log((counts.get((l, n, g), 0) + language_id.ALPHA) / (total.get((l, n), 0) + language_id.ALPHA * (size[n] + 1)))
    has = {(n, g) for _, n, g, *_ in learnt}

    def word(l, w):
        if (0, w) in has:
            return log(l, 0, w)
        marked, out = f"_{w}_", 0.0
        for i in range(len(marked) - 1):
            n = next((n for n in (4, 3, 2, 1) if i + n <= len(marked) and (n, marked[i : i + n]) in has), None)
            out += log(l, n, marked[i : i + n]) if n else 0.0
        return out / (len(marked) - 1)

    model = language_id.LanguageModel(learnt)
    monkeypatch.setattr(language_id, "MEMORY", 0)
    small = language_id.LanguageModel(learnt)
    for text in [t for _, t, _ in rows] + ["qqq zzz abca", "Abc, ABC! 12", "ééé x", "q" * 300, " ".join(f"{a}{b}{c}" for a in "abxyz" for b in "abxyz" for c in "abcdefgh") * 60]:
        sums = {l: sum(word(l, w) for w in re.findall(r"[^\W\d_]+", text.lower())) for l in make}
        best = min(make, key=lambda l: (-sums[l], l))
        share = 1 / sum(math.exp(max(s - sums[best], -700)) for s in sums.values())
        for m in (model, small):
            lang, score = m.predict(text)
            assert abs(score - share) < 1e-6 and (lang == best or abs(sums[lang] - sums[best]) < 1e-6), text[:50]


def test_too_large_models_are_errors(spark, monkeypatch):
    df = spark.createDataFrame([(i, "some words", f"l{i}") for i in range(40)], "doc_id long, text string, lang string")
    monkeypatch.setattr(language_id, "MAX_ENTRIES", 5)
    with pytest.raises(ValueError, match="at most 5"):
        language_id.identify(df)
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 3)
    with pytest.raises(ValueError, match="at most 3"):
        language_id.identify(df)


def test_language_edges(spark):
    none = spark.createDataFrame([(None, "a", "en"), (1, None, "en"), (2, "b", None)], "doc_id long, text string, lang string")
    got = sorted(map(tuple, language_id.identify(none).collect()), key=str)
    assert {(r[2], r[3]) for r in got} == {("und", 0.0)} and len(got) == 3
    assert language_id.identify(none.limit(0)).count() == 0


# main text

NAV = "<nav><a href=/a>Menu one</a></nav><div class='ad-box'>Buy now</div>"
FOOT = "<aside>side words</aside><footer>&copy; me</footer>"


def page(body, title="T"):
    return f"<!doctype html><html><head><title>{title}</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{NAV}{body}{FOOT}</body></html>"


def test_main_text(spark):
    text = "Some words of a story that goes on &amp; on, <b>bo</b>ld\n and&nbsp;long. " * 6
    clean = " ".join(("Some words of a story that goes on & on, bold and long. " * 6).split())
    deep = lambda n, more="": page(f"<div class='c{n} main-{n}'><h1>Head</h1><p>{text}<p>{text}</div>{more}")
    rows = [(i, f"http://One.example/{i}", deep(i)) for i in range(8)]
    rows += [
        (20, "http://one.example/short", page("<div class='c9 main-9'><p>tiny</div><div class=other><p>" + text * 4 + "</div>")),  # clearly better than what the host's path has
        (19, "http://one.example/near", page(f"<div class='c9 main-9'><p>{text}</div><div class=other><p>" + text * 3 + "</div>")),  # the host's path wins over the longer text
        (21, "http://one.example/lost", page(f"<section><p>{text}</section>")),  # no such path: its own best
        (22, None, deep(1)), (23, "http://one.example/n", None), (24, "x", ""), (25, "x", "plain &lt;text&gt;"), (26, "http://two.example", deep(1, f"<div class=comments><p>{text * 9}</div><form><p>{text * 9}</form>")),
        (27, "http://one.example/broken", page(f"<div class='c1 main-1'><p><b>{text}<br><p>tail")), (28, "x", "<p>unclosed <script>bad"),
    ]
    got = {r["page_id"]: r for r in host_paths.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("path", F.lit("clash"))).collect()}
    for i in (*range(8), 22, 26):
        assert got[i]["text"] == f"Head {clean} {clean}", i
    assert got[20]["text"] == " ".join([clean] * 4) and got[19]["text"] == clean and got[21]["text"] == clean and got[27]["text"] == f"{clean} tail"
    assert (got[23]["text"], got[24]["text"], got[25]["text"], got[28]["text"]) == ("", "", "plain <text>", "unclosed")
    assert all(r["n_chars"] == len(r["text"]) for r in got.values()) and len(got) == len(rows)
    assert host_paths.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pages_within_a_form():
    """A form around the page is layout; one that asks for something stays noise."""
    text = "Some words of a story that goes on and on. " * 6
    clean = text.strip()
    search = "<form class=search><label>Search this site</label><input name=q></form>"
    login = "<form id=login><p>Name and password, please.</p><input></form>"
    asp = f"<html><body><form id='aspnetForm' action='x'>{NAV}<div class='content'><h1>Head</h1><p>{text}</p></div>{FOOT}</form></body></html>"
    for html, want in (
        (asp, f"Head {clean}"), (f"<body>{NAV}<form><article><p>{text}</p></article></form>{search}{login}</body>", clean),
        (page(f"{search}<div class=story><p>{text}</p>{login}</div>"), clean), (page(f"<article><p>{text}</p></article><form><p>{text * 3}</p></form>"), clean),
    ):
        assert host_paths.extract(html, []) == want
        assert host_paths.extract(html, [host_paths.Page(html).spelled(host_paths.Page(html).best()[0])]) == want


def test_articles_with_and_without_a_host():
    html = page("<article><p>First one, with some words.</p></article><article><p>Second one, with some more words.</p></article>")
    want = "First one, with some words. Second one, with some more words."
    assert host_paths.extract(html, []) == want == host_paths.extract(html, ["html>body>article"])


def test_names_that_are_no_noise():
    text = "Some words of a story that goes on and on. " * 5
    clean, art = text.strip(), f"<article><p>{text}</article>"
    get = lambda body: host_paths.extract(page(body), [])
    for wrap in ("class='has-sidebar'", "id=page class='nav-open'", "class=search-page", "class=sidebar", "class='modal share'", "id=comments"):
        assert get(f"<div {wrap}>{art}</div>") == clean, wrap
        assert get(f"<div {wrap}><main><p>{text}</main></div>") == clean, wrap
    assert get(f"<div class=search><p>{text}</div>") == clean
    got = get(f"<article><h2 id='related-work'>Related work</h2><p>{text}<section id='comments-on-x'><p>Rest</section></article>")
    assert got == f"Related work {clean} Rest"
    for noise in ("class=left-sidebar", "class=sidebar-left", "id=share-buttons", "class=relatedPosts", "class='x comment-list'", "class=cookie"):
        assert get(f"<article><p>{text}<div {noise}><p>noise</div></article>") == clean, noise
    replies = f"<div id=comments><article class=comment-body><p>{text * 9}</article></div>"
    assert get(art + replies) == clean  # however long
    assert get(f"<article><p>short</article><div class=ad>{text}</div>") == "short"


def test_no_text_is_lost_to_quotes_or_broken_tags():
    get = lambda body: host_paths.extract(page(f"<article>{body}</article>"), [])
    assert get("<p title=it's>One...</p><p>Two, don't lose.</p><p>Three.</p>") == "One... Two, don't lose. Three."
    assert get("""<p it's title = "a > b" x='>'>One</p><p class=a"b>5 < 6 </ p>two<//>.</p>""") == "One 5 < 6 two."
    assert get("<p>a<!-- x > -- <p> -->b<!>c<?php echo '>'?></p>") == "abc'?>"  # as a browser reads it
    assert host_paths.extract("<p>One <b>two</b> <a href='x", []) == "One two"
    assert host_paths.extract("x < y & z &lt; <", []) == "x < y & z < <"
    assert get("<p>One<svg>no</svg><object>two") == "Onetwo"  # an object that is never closed hides nothing
    assert get("<select><option>no<option>no</select><div/>yes <a href=http://x/>link</a>") == "yes link"


def test_headlines_and_sections_around_the_body():
    text = "Some words of a story that goes on and on. " * 9
    clean = text.strip()
    get = lambda body: host_paths.extract(page(body), [])
    assert get(f"<article><h1>Head</h1><p>Lead</p><div class='body'><p>{text}</p></div></article>") == f"Head Lead {clean}"
    assert get(f"<div class=post><h1>Head</h1><p>Lead</p><div class='body'><p>{text}</p></div></div>") == f"Head Lead {clean}"
    assert get(f"<div class=post><section class=intro><p>{text}</section><section class=body><p>{text * 3}</section></div>") == f"{clean} {(text * 3).strip()}"
    assert get(f"<article><div><div class=a><p>{text}</div><div class=b><p>{text}</div></div><div class=c><h2>End</h2><p>bye</div></article>") == f"{clean} {clean} End bye"
    assert get(f"<h1>Head</h1><div class=text><p>{text}</div>") == f"Head {clean}"
    assert get(f"<div class=text><p>{text}</div><div class=more><ul><li><a href=x>{clean[:80]}</a></ul></div><p>(c) us") == clean
    assert get(f"<main><h1>Head</h1><article><p>{text}</article></main>") == f"Head {clean}"


def test_time_and_memory_grow_with_the_page():
    import time

    def seconds(html):
        began = time.process_time()
        host_paths.extract(html, ["html>body>div"])
        return time.process_time() - began

    shapes = ["<a ", "<a x='", '<p title="', "<!-- ", "</x ", "<p>x</b>", "<textarea>x", "<li><b>", "<ul><li>a", "<b><li>x</li>", "<script>", "<main><div>x", "< ", "</", "<div class=comment>x", "<x y", "=\"'<p ", "<blockquote>a"]
    for shape in shapes:
        small, large = "<body>" + shape * (60_000 // len(shape)), "<body>" + shape * (600_000 // len(shape))
        assert seconds(large) < 40 * seconds(small) + 1, shape
    deep = "<div class=c>" * 50_000 + "<p>bottom" + "</span>" * 50_000
    assert host_paths.extract(deep, []) == "bottom" and seconds(deep) < 10
    assert seconds("<a " * 350_000) < 2


def test_main_text_against_a_dom_walk(spark, monkeypatch):
    """Pages made from a tree; the plain walk over that tree says what must come out. Both ways of meeting the winners."""
    rng = random.Random(9)
    word = lambda: rng.choice(["alpha", "be&amp;ta", "it's", "5 &lt; 6", "é&eacute;", "x\n y", '"q"'])
    import html as entities

    def block():
        """(markup, text or nothing)."""
        text = " ".join(word() for _ in range(rng.randint(3, 30)))
        seen = " ".join(entities.unescape(text).split())
        kind = rng.randrange(9)
        if kind == 0:
            return f"<nav class='c{rng.randrange(9)}'><p>{text}</p></nav>", ""
        if kind == 1:
            return f"<div class=advert title=it's><p>{word()}</div>", ""
        if kind == 2:
            return f"<script>var a = '<p>{text}</p>'</script><!-- <p>{text}</p> -->", ""
        if kind == 3:
            return f"<ul><li>{text}<li><b>{text}</b></ul>", f"{seen} {seen}"
        if kind == 4:
            inner = [block() for _ in range(rng.randint(1, 3))]
            return "<section>" + "".join(m for m, _ in inner) + "</section>", " ".join(t for _, t in inner if t)
        return f"<p data-x=\"a > b\" {'hidden2' if kind == 5 else ''}>{text}" + ("</p>" if kind != 6 else ""), seen

    rows, want = [], {}
    for i in range(150):
        parts = [block() for _ in range(rng.randint(8, 16))]
        rows.append((i, rng.choice(["http://a.org/x", "http://b.org/y", None, f"http://h{i}.org"]), page("<article>" + "".join(m for m, _ in parts) + "</article>")))
        want[i] = " ".join(t for _, t in parts if t)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for most in (host_paths.BROADCAST_HOSTS, 0):
        monkeypatch.setattr(host_paths, "BROADCAST_HOSTS", most)
        assert {r["page_id"]: r["text"] for r in host_paths.extract_pages(df).collect()} == want


def test_elements_that_share_the_winning_path():
    story = "Some words of a story that goes on and on. " * 9
    clean = story.strip()
    bare = ["html>body>div"]
    get = lambda body, winners: host_paths.extract(f"<html><body>{body}</body></html>", winners)
    assert get(f"<div>Home About</div><div><p>{story}</p></div><div>Copyright 2020 us</div>", bare) == clean
    assert get(f"<div><p><a href=x>Home</a> <a href=y>About</a></div><div>{story}</div><div><p>&copy; 2020 us</div>", bare) == clean
    assert get(f"<div><h2>One</h2><p>{story}</div><div><h2>Two</h2><p>short</div>", bare) == f"One {clean} Two short"
    assert get(f"<div class=post>{story}</div><div class=post>short</div>", ["html>body>div.post"]) == f"{clean} short"
    assert get("<div></div><div></div>", bare) == ""


def test_pages_of_several_templates():
    story = "Some words of a story that goes on and on. " * 9
    clean, teaser = story.strip(), "A teaser of some words that is short."
    both = f"<html><body><div class=story><p>{story}</p></div><div class=post><p>{teaser}</p></div></body></html>"
    assert host_paths.extract(both, ["html>body>div.post"]) == clean  # the page's own container is clearly better
    assert host_paths.extract(both, ["html>body>div.post", "html>body>div.story"]) == clean
    near = both.replace(teaser, story[:200])
    assert host_paths.extract(near, ["html>body>div.post", "html>body>div.story"]) == story[:200].strip()  # of comparable ones the one with most votes


def test_layout_by_table_cells():
    story = "Some words of a story that goes on and on. " * 9
    clean = story.strip()
    get = lambda body: host_paths.extract(f"<html><body>{body}</body></html>", [])
    rows = lambda cell: f"<table><tr><td colspan=2>Site</td></tr><tr><td>Home<br>About us</td><td>{cell}</td></tr></table>"
    assert get(rows(f"<div class=text><h1>Head</h1><p>{story}</div>")) == f"Head {clean}"
    assert get(rows(f"<h1>Head</h1><p>{story}")) == f"Head {clean}"
    assert get(rows(f"<p>{story}<p>{story}<table><tr><td>1<td>2</table>")) == f"{clean} {clean} 1 2"
    assert get(f"<article><p>{story}<table><tr><td><p>a<p>b<td><p>c</table></article>") == f"{clean} a b c"  # a table of an article is a part of it


def test_votes_of_several_templates_against_the_trees(spark):
    """Hosts with two templates, without classes, with a form around the page: what was put in as the article comes out."""
    rng = random.Random(21)
    words = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) for _ in range(n))

    def article():
        parts = [words(rng.randint(25, 60)) for _ in range(rng.randint(2, 6))]
        return "".join(f"<p>{t}</p>" for t in parts), " ".join(parts)

    shells = {
        "two.org": ["<div class=story>{}</div><div class=post><p>a teaser</p></div>", "<div class=post>{}</div>"],
        "bare.org": ["<div>Home About</div><div>{}</div><div>Copyright 2020 us</div>"],
        "form.org": ["<form id=aspnetForm><div class=menu>Home</div><div class=content>{}</div></form>"],
        "cells.org": ["<table><tr><td>Home<br>About</td><td>{}</td></tr></table>"],
    }
    rows, want = [], {}
    for i in range(160):
        host = rng.choice(list(shells))
        markup, want[i] = article()
        rows.append((i, f"http://{host}/{i}", f"<html><body>{rng.choice(shells[host]).format(markup)}</body></html>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in host_paths.extract_pages(df).collect()} == want
    paths = {r["host"]: set(r["paths"]) for r in host_paths.vote(df).collect()}
    assert paths["two.org"] == {"html>body>div.story", "html>body>div.post"} and all(len(p) == 1 for h, p in paths.items() if h != "two.org")


def test_hosts(spark):
    urls = ["HTTP://User@Www.X.org:80/a?b#c", "//y.org/z", "no host", None, "https:///"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(host_paths.host_of(F.col("u"))).collect()]
    assert got == ["www.x.org", "y.org", None, None, None]

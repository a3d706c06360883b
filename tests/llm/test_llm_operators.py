"""The training-data operators against brute force, on rows that are null, empty, long, equal or repeated."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import decontaminate, imatch, language, mixing, ngram_join, relative_lz, sharding, surrogates, token_files, url_filter
from leafmill.llm.queries import QUERIES, URL_RULES, tokenizer_definition
from leafmill.llm.tokenize import PieceTokens
from leafmill.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns that operators use for their own results or steps.
CLASHING = ["n_words", "node", "key", "label", "shard", "weight", "block", "rule", "score", "lang_pred", "_row"]


def numbered(first, n, word="w"):
    return " ".join(f"{word}{i}" for i in range(first, first + n))


TEXTS = [
    None, "", " \t\n", "one", "One", "one two three four", numbered(0, 60), numbered(0, 60), numbered(1, 60), numbered(4, 60),
    numbered(30, 60), numbered(30, 60) + " " + numbered(200, 20), "x " * 400, "x " * 401, "é è ü 日本語 " * 9, "\u00a0a\u00a0b",
    numbered(0, 3000), numbered(0, 3000).upper(), numbered(0, 2990) + " end", numbered(500, 13, "q"), "a " + numbered(500, 13, "q") + " b",
]
ROWS = list(enumerate(TEXTS)) + [(6, TEXTS[6])]  # one row twice


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string").withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 3))
    return df.select("*", *[F.lit("mine").alias(c) for c in CLASHING]).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def rows_of(df, *columns):
    return Counter(map(tuple, df.select(*columns).collect()))


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def shingles(text):
    words = SPACED.findall(lower(text))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def components(rows):
    ids = {i: shingles(t) for i, t in rows}
    least = {i: i for i in ids}
    links = [(a, b) for a in ids for b in ids if a < b and ids[a] and ids[b] and 100 * len(ids[a] & ids[b]) >= 80 * len(ids[a] | ids[b])]
    for _ in ids:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    return Counter((i, len(ids[i]), least[i]) for i, _ in rows)


def test_near_components(docs, empty):
    found = rows_of(ngram_join.near_components(docs), "doc_id", "n_shingles", "component_id")
    assert found == components(ROWS)
    assert ngram_join.near_components(empty).count() == 0


def test_chain_of_near_copies_is_one_component(spark):
    """Neighbours are similar, the ends are not: only transitive links join them."""
    chain = [(i, numbered(3 * i, 80)) for i in range(25)]
    found = rows_of(ngram_join.near_components(spark.createDataFrame(chain, "doc_id bigint, text string")), "doc_id", "n_shingles", "component_id")
    assert found == components(chain)
    assert {c for _, _, c in found} == {0}


def test_drop_near_copies_keeps_columns_and_wordless_rows(docs):
    kept = ngram_join.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert {0, 1, 2} <= {r.doc_id for r in kept.select("doc_id").collect()}


@pytest.mark.parametrize("most", [ngram_join.BROADCAST_KEYS, 0])
def test_drop_near_copies_of_repeated_and_null_ids(spark, monkeypatch, most):
    """An id stays with all its rows if one of them names its component; a null id only where no id is beside it."""
    monkeypatch.setattr(ngram_join, "BROADCAST_KEYS", most)
    a, b, c = numbered(0, 60), numbered(100, 60), numbered(200, 60)
    rows = [(1, a), (5, a), (5, b), (6, b), (6, b), (7, None), (8, ""), (9, c)]
    for nulls, left in (([(None, c)], []), ([(None, c), (None, "alone")], [(None, c), (None, "alone")]), ([(None, None)], [(None, None)])):
        docs = spark.createDataFrame(rows + nulls, "doc_id bigint, text string").repartition(3)
        kept = rows_of(ngram_join.drop_near_copies(docs), "doc_id", "text")
        assert kept == Counter([(1, a), (5, a), (5, b), (7, None), (8, ""), (9, c)] + left)


def test_drop_near_copies_moves_no_text(spark):
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ngram_join.drop_near_copies(spark.createDataFrame(ROWS, "doc_id bigint, text string"))
        plan = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_sets_send_keys_for_each_band_that_may_hold_partners():
    """Linked sets of every size agree in enough keys; a set too large for the band below sends none for it."""
    draw, twice = np.random.default_rng(5), 0
    for n in range(1, 900):
        larger = draw.integers(0, 1 << 64, n * 5 // 4, np.uint64)
        keys, other = (ngram_join.segment_keys(np.unique(x)) for x in (larger[:n], larger))
        common = np.intersect1d(keys, other)
        assert max(int((common & np.uint64(1) == bit).sum()) for bit in (0, 1)) >= ngram_join.SPARE, n
        twice += len(set((keys & np.uint64(1)).tolist())) == 2
    assert twice < 600


def without_repeats(rows, size=13):
    first = {}
    words = [(i, SPACED.findall(t or "")) for i, t in rows]
    for i, own in words:
        for at in range(len(own) - size + 1):
            gram = tuple(own[at : at + size])
            first[gram] = min(first.get(gram, i), i)
    for i, own in words:
        gone = {p for at in range(len(own) - size + 1) if first[tuple(own[at : at + size])] < i for p in range(at, at + size)}
        yield i, len(own), len(gone), " ".join(w for p, w in enumerate(own) if p not in gone)


@pytest.mark.parametrize("parts", [1, 7])
def test_drop_repeats(docs, empty, parts):
    made = relative_lz.drop_repeats(docs, parts=parts)
    assert rows_of(made, "doc_id", "n_words", "n_removed", "text") == Counter(without_repeats(ROWS))
    assert relative_lz.drop_repeats(empty).count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_factors_and_literals_give_the_text(spark, parts):
    random.seed(parts)
    passages = [" ".join(f"p{i}w{j}" for j in range(40)) for i in range(6)] + ["la " * 60, "a b " * 30]
    texts = []
    for i in range(120):
        cut = [p.split()[random.randint(0, 12) : random.randint(20, 40)] for p in random.choices(passages, k=3)]
        texts.append(" ".join(" ".join([*own, *(f"d{i}x{j}" for j in range(random.randint(0, 2)))]) for own in cut))
    texts += [texts[3], "", None, " ".join(texts[:40])]
    order = random.sample(range(len(texts)), len(texts))
    rows = spark.createDataFrame([(i, texts[i]) for i in order], "doc_id bigint, text string").repartition(4)
    words = [SPACED.findall(t or "") for t in texts]
    made = {r.doc_id: r for r in relative_lz.drop_repeats(rows, parts=parts).collect()}
    assert len(made) == len(texts) and sum(len(r.factors) for r in made.values()) > 300
    for i, row in made.items():
        done, covered = 0, set()
        for first, end, source, there in row.factors:
            assert done <= first < end and source < i
            assert words[i][first:end] == words[source][there : there + end - first]
            done = end
            covered.update(range(first, end))
        assert covered == {p for a, b in row.spans for p in range(a, b)} and len(covered) == row.n_removed
        assert row.text == " ".join(w for p, w in enumerate(words[i]) if p not in covered)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in made.values()) == Counter(without_repeats(list(enumerate(texts))))


def test_decontamination(spark, docs, empty):
    items = [(1, numbered(500, 13, "Q")), (2, "one"), (3, None), (None, numbered(0, 30)), (4, ""), (5, numbered(40, 15)), (5, numbered(40, 15))]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    marked = decontaminate.mark_contamination(docs, table)
    digest = decontaminate.items_sha256(F.col("item_ids")).alias("digest")
    found = rows_of(marked, "doc_id", "n_words", "n_hit", F.size("item_ids"), digest, "contaminated")
    assert found == Counter(decontaminate.brute_force(ROWS, items))
    small_blocks = decontaminate.mark_contamination(docs, table, block_words=5)
    assert rows_of(small_blocks, "doc_id", "n_hit") == rows_of(marked, "doc_id", "n_hit")
    kept = decontaminate.drop_contaminated(docs, table)
    assert kept.columns == docs.columns
    assert kept.count() == marked.where("not contaminated").count()
    assert decontaminate.mark_contamination(empty, table).count() == 0
    assert decontaminate.mark_contamination(docs, table.limit(0)).where("n_hit > 0").count() == 0


def test_fingerprints(docs, empty):
    made = imatch.fingerprint_documents(docs).collect()
    assert len(made) == len(ROWS)
    ordered = sorted(ROWS, key=lambda r: (r[0], r[1] or ""))
    expected = Counter()
    for (i, t), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        t, following = t or "", following or ""
        n = len(t) // 2
        cut = t[: len(t) - n] + following[:n]
        expected[i, len(t), hashlib.sha256(cut.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in made) == expected
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in made)
    prints = {}
    for r in made:
        prints.setdefault(TEXTS[r.doc_id] or "", set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert imatch.fingerprint_documents(empty).count() == 0


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://A.Example.NET/en/x?q#f", "http://example.net/de", "https://badexample.com/de/", "http://x.example.com/de/1",
        "http://a.org/fr/", "http://a.org/fr", "net://net/", "http://net", "http://my.cheap-pills.biz/", "http://cheap-pills.biz/", "://x.net/a", "a://b://c.net/",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumn("host", F.lit("mine"))
    listed = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    found = {r.page_id: r for r in url_filter.judge_urls(pages, URL_RULES).collect()}
    for i, url in enumerate(urls):
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
        host, path = (lower(m[1]), m[2]) if m else ("", "")
        fits = [r for r in listed if ("." + host).endswith("." + r[0]) and path.startswith(r[1])]
        best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, best and best[0] + best[1]), url
        if best:
            assert found[i].verdict == best[2]
    assert found[11].verdict == "block"
    assert url_filter.judge_urls(pages.limit(0), URL_RULES).count() == 0


def test_token_files_round_trip(spark, docs, empty):
    from tokenizers import Tokenizer

    definition = tokenizer_definition()
    path = scratch_path(spark, "test-tokens")
    token_files.write_token_files(docs, path, definition, shard_tokens=500)
    tokenizer, start, expected, all_ids = Tokenizer.from_str(definition), 0, Counter(), []
    for i, t in sorted(ROWS, key=lambda r: (r[0], r[1] or "")):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        expected[i, start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))] += 1
        start, all_ids = start + len(ids), all_ids + ids
    assert rows_of(token_files.read_documents(spark, path), "doc_id", "start", "n_tokens", "ids_crc32") == expected
    wanted = [2, all_ids[10]]
    assert {r.token: r.n for r in token_files.count_tokens(spark, path, wanted).collect()} == {t: all_ids.count(t) for t in wanted}
    places = {(r.token, r.position) for r in token_files.find_tokens(spark, path, wanted).collect()}
    assert places == {(t, p) for p, t in enumerate(all_ids) if t in wanted}
    asked = spark.createDataFrame([(p,) for p in range(0, start, 97)], "position bigint")
    assert all(r.token == all_ids[r.position] for r in token_files.tokens_at(path, asked).collect())
    nothing = scratch_path(spark, "test-no-tokens")
    token_files.write_token_files(empty, nothing, definition)
    assert token_files.read_documents(spark, nothing).count() == 0


def test_token_workers_keep_no_pieces(spark):
    """An idle worker has its tokenizer, and nothing of what its last task has learnt."""
    words = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.sha1(F.concat("id", F.lit(f"-{i}"))) for i in range(4)]).alias("text"))
    token_files.write_token_files(words, scratch_path(spark, "test-idle"), tokenizer_definition())

    def held(batches):
        import sys
        import pyarrow as pa

        for _ in batches:
            found = list(vars(sys.modules["_leafmill_tokens"]).values()) if "_leafmill_tokens" in sys.modules else []
            yield pa.RecordBatch.from_pydict({"n": [len(x.codes) for x in found if hasattr(x, "codes")]}, pa.schema([("n", pa.int64())]))

    idle = [r.n for r in spark.range(0, 64, 1, 16).mapInArrow(held, "n bigint").collect()]
    assert idle and not any(idle)


def test_pieces_take_little_memory():
    import tracemalloc

    tokens, words = PieceTokens(tokenizer_definition()), [hashlib.sha1(b"%d" % i).hexdigest() for i in range(5000)]
    words = [re.sub("[0-9]", lambda m: "ghijklmnop"[int(m[0])], w)[:12] for w in words]  # one piece each
    tracemalloc.start()
    try:
        for first in range(0, 5000, 250):
            tokens.encode([" ".join(words[first : first + 250])])
        taken = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert len(tokens.codes) == 5000
    assert taken < 300 * 5000


def test_only_distinct_words_are_cut(monkeypatch):
    """Texts are cut into words in array operations; a word that comes often is cut into pieces and looked up once a group."""
    from leafmill.llm import tokenize

    cut, pattern = [], tokenize._PIECE

    class Counted:
        @staticmethod
        def findall(text):
            cut.append(len(text))
            return pattern.findall(text)

    monkeypatch.setattr(tokenize, "_PIECE", Counted)
    tokens, text = PieceTokens(tokenizer_definition()), "it's a Word, and\nword 42 d\u00e9j\u00e0 " * 5000
    ids, sizes = tokens.encode([text, None, text], end=2)
    once = tokens.tokenizer.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == [*once, 2, 2, *once, 2] and sizes.tolist() == [len(once) + 1, 1, len(once) + 1]
    assert sum(cut) < 100


def test_piece_tokens_of_odd_texts():
    """Groups that mix plain texts, texts encoded as a whole, empty ones and nulls, with and without the end id."""
    tokens, chance = PieceTokens(tokenizer_definition()), random.Random(3)
    plain = [*"abcABCsStTrevmld019 .,-'\n\n  \u00e9\u00c9\u00df\u00ff\u00de", "'s", "'ll", "'Re", "''s", "<", "|"]
    odd = [*plain, "\t", "\r", "\x85", "\u00d7", "\u6f22", "e\u0301", "<|", "<|endoftext|>"]

    def text():
        kind = chance.choice([plain, plain, odd, [""], [" ", "\n"]])
        return chance.choice([None, *["".join(chance.choices(kind, k=chance.choice([1, 3, 8, 40])))] * 9])

    for _ in range(400):
        texts, end = [text() for _ in range(chance.randrange(7))], chance.choice([None, 2])
        wanted = [tokens.tokenizer.encode(t or "", add_special_tokens=False).ids + [2] * (end == 2) for t in texts]
        ids, sizes = tokens.encode(texts, end)
        assert ids.tolist() == [i for w in wanted for i in w] and sizes.tolist() == [len(w) for w in wanted]


def test_wavelet_planes_of_many_blocks(monkeypatch):
    monkeypatch.setattr(token_files, "MOVED", 64, raising=False)
    for n in (0, 1, 63, 64, 65, 1000, 5000):
        ids = np.random.default_rng(n).integers(0, 1 << 17, n).astype(np.uint32)
        matrix = token_files.WaveletMatrix(n, *token_files.WaveletMatrix.build(ids, 17))
        assert matrix.ids().tolist() == ids.tolist()
        assert [matrix.access(i) for i in range(0, n, 97)] == ids[::97].tolist()


def test_shards(docs, empty):
    made = sharding.minimax_shards(docs).collect()
    assert Counter((r.doc_id, r.size) for r in made) == Counter((i, len((t or "").encode()) + 1) for i, t in ROWS)
    slots, loads, places = {}, Counter(), {}
    for r in made:
        slots.setdefault(r.shard, []).append(r.slot)
        loads[r.shard] += r.size
        places.setdefault(TEXTS[r.doc_id], set()).add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
    assert all(len(p) == 1 for p in places.values())
    assert sharding.minimax_shards(empty).count() == 0


def test_smallest_capacity(spark):
    sizes = [7, 2, 9, 4, 4, 1, 12, 3, 5, 5, 8]
    texts = [(i, chr(97 + i) * (n - 1)) for i, n in enumerate(sizes)]
    made = sharding.minimax_shards(spark.createDataFrame(texts, "doc_id bigint, text string"), shards=4)
    assert max(r["sum(size)"] for r in made.groupBy("shard").sum("size").collect()) == sharding.brute_force(sizes, 4)


def test_language_is_learnt(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    made = QUERIES["op8_cross_parsing_language"](spark, SF_DIR).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    right, total = made.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert total > 20 and right / total > 0.8, (right, total)


def test_language_of_odd_texts(docs, empty):
    samples = {"en": b"the cat and the dog went to the house", "de": b"der hund und die katze gingen in das haus"}
    found = {r.doc_id: r for r in language.identify(docs, samples).collect()}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (0, 1, 2))
    assert all(0 <= r.score <= 1 for r in found.values())
    assert language.identify(empty, samples).count() == 0
    assert {r.lang_pred for r in language.identify(docs, {}).collect()} == {"und"}


def test_mixing(docs, empty):
    made = mixing.mix_sources(docs, target_entropy=0.95, max_repeats=4.0).collect()
    per_source = {r.source: r.weight for r in made}
    assert sum(per_source.values()) == pytest.approx(1, abs=1e-6) and all(r.epoch < 5 for r in made)
    total = sum(len(SPACED.findall(t or "")) for _, t in ROWS)
    assert sum(len(SPACED.findall(r.text or "")) for r in made) <= total
    plain = mixing.mix_sources(docs, target_entropy=0.95, max_repeats=4.0, details=False)
    assert plain.columns == docs.columns and plain.count() == len(made)
    assert mixing.mix_sources(empty).count() == 0


def test_surrogates(spark, docs, empty):
    texts = ["Write to ann.lee@example.com or bob@example.com.", "ann.lee@example.com again", None, "", "nothing here", "Call from 192.168.4.7"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("n_email", F.lit("mine"))
    made = {r.doc_id: r for r in surrogates.replace_entities(table, b"k").collect()}
    address = r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+"
    first, second = re.findall(address, made[0].text.rstrip("."))[:2], re.findall(address, made[1].text)
    assert made[0].n_email == 2 and len(set(first)) == 2 and first[0] == second[0]
    assert not {"ann.lee@example.com", "bob@example.com"} & set(first)
    assert made[2].text is None and made[3].text == "" and made[4].text == "nothing here"
    other = {r.doc_id: r for r in surrogates.replace_entities(table, b"another").collect()}
    assert other[0].text != made[0].text
    assert surrogates.replace_entities(empty, b"k").count() == 0


def test_surrogates_keep_people_apart_and_together(spark):
    texts = [
        "Mrs Anna Lee met Mr Lee and Mr Karl Berg", "Mrs Lee left; Mr Berg stayed", "Mr Karl Lee, 123-45-6789 and 987-65-4321",
        "pay to DE89 3704 0044 0532 0130 00 now", "Mr 李明 and Mr Ли",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("_tries", F.lit("mine"))
    made = {r.doc_id: r for r in surrogates.replace_entities(rows, b"k").collect()}
    assert all(r._tries == "mine" for r in made.values())
    first = re.fullmatch(r"Mrs (\w+) (\w+) met Mr (\w+) and Mr (\w+) (\w+)", made[0].text).groups()
    anna, lee, lee_too, karl, berg = first
    assert lee == lee_too != berg and len({*first}) == 4 and not {*first} & {"Anna", "Lee", "Karl", "Berg"}
    assert made[1].text == f"Mrs {lee} left; Mr {berg} stayed"
    assert made[2].text.startswith(f"Mr {karl} {lee}, ") and (made[0].n_name, made[2].n_ssn) == (3, 2)
    account = re.search("DE[0-9 ]+[0-9]", made[3].text)[0].replace(" ", "")
    assert account != "DE89370400440532013000" and surrogates._remainder_97(account[4:] + account[:4]) == 1
    assert re.fullmatch(r"Mr [\u4e00-\u9fff]{2} and Mr [\u0400-\u04ff]+", made[4].text) and "李明" not in made[4].text


def test_surrogates_are_no_real_entity(spark):
    numbers = [f"{i:03d}-11-{j:04d}" for i in range(1, 30) for j in range(100)]
    rows = spark.createDataFrame([(0, " ; ".join(numbers))], "doc_id bigint, text string")
    now, _ = surrogates.assign_surrogates(rows, b"k")
    made = now.collect()
    assert len(made) == len(numbers) == len({r.made for r in made})
    assert not {r.made for r in made} & {r.entity for r in made}


@pytest.mark.parametrize("unit", ["a", "a.", "a@", "1", "1 ", "1-", "A", "x=", "Mr ", "token "])
def test_entities_of_a_long_run_take_linear_time(unit):
    begun = time.process_time()
    surrogates.find("@" + unit * (2_000_000 // len(unit)))
    assert time.process_time() - begun < 20


def test_a_long_secret_takes_linear_time():
    begun = time.process_time()
    made = surrogates.surrogate(b"k", "secret", "0123456789abcdef" * 20_000)
    assert len(made) == 320_000 and time.process_time() - begun < 10


def test_permutation_is_one_to_one():
    assert sorted(surrogates.permute(b"k", "x", i, 1000) for i in range(1000)) == list(range(1000))

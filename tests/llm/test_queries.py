"""The registered queries of the corpus operators, every column, against plain computations."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from lexiloom.llm import pretok, queries

BLANK = r"[^\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows():
    rng = random.Random(21)
    words = "the of and to in a is that it was for on it's we'll État 日本 naïve 12 3.5 x_y 👍 no".split()
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    license_line = "This line is found in very many of the documents here."
    texts = [say(rng.randint(0, 90)) + (f"\n{license_line}" if k % 3 == 0 else "") + (f"\n  {license_line.upper()}\t" if k % 5 == 0 else "") for k in range(60)]
    texts += [None, "", " \n\t", "One", "one", "ONE TWO", "w " * 3000, texts[4], texts[4].upper(), texts[7] + " more", "a\n\na\n\n", "x" * 5000]
    texts += [
        "mail a.b@c.org, ip 10.0.0.256 or 192.168.1.1.5, card 4111 1111 1111 1111 and 4111-1111-1111-1112",
        "+49 (30) 123-4567 89 and +1 2 or a@b@c.de.x @x.y a@b", "é 👍 192.168.0.1 é x@y.zz", "5500005555555559" * 2 + " 00000000000000000 +123456789012345678",
    ]
    out = [(3 * k + 1, t) for k, t in enumerate(texts)]
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("world")
    data = [(i, t, ("en", "fr", None)[i // 3 % 3], f"s{i % 4}", len(t or ""), "x", 7) for i, t in rows()]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, __go string, keep_id int").repartition(3).write.parquet(f"{folder}/documents.parquet")
    pages = [(i, f"https://h{i // 3 % 3}.example.{("com", "fr")[i % 2]}/{i}", f"<html lang='{('en', 'fr')[i % 2]}'><body>{t or ''}</body></html>") for i, t in rows()]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def ids():
    library = Tokenizer.from_file(pretok.vocab_path())
    return {i: library.encode(t or "", add_special_tokens=False).ids for i, t in rows()}, library


def got(spark, world, name, key="doc_id"):
    out = {r[key]: r.asDict() for r in queries.queries()[name](spark, world).collect()}
    assert len(out) == len(rows())
    return out


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1(spark, world):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    held = defaultdict(set)
    for i, t in rows():
        for x in (t or "").split("\n"):
            held[key(x)].add(i)
    result, dropped = got(spark, world, "op1_line_dedup"), 0
    for i, t in rows():
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (len(key(x)) >= 40 and len(held[key(x)]) >= 5 and max(held[key(x)]) != i)]
        assert result[i] == {"doc_id": i, "n_lines": len(lines), "n_dropped": len(lines) - len(stay), "kept_sha256": sha("\n".join(stay))}
        dropped += len(lines) - len(stay)
    assert dropped > 20


def test_op2(spark, world, ids):
    result, start = got(spark, world, "op2_token_store"), 0
    for i, _ in sorted(rows(), key=lambda r: r[0]):
        own = [*ids[0][i], 2]
        assert result[i] == {"doc_id": i, "start": start, "n_tokens": len(own), "ids_crc32": crc(own)}
        start += len(own)


def test_op3(spark, world, ids):
    result = got(spark, world, "op3_token_counts")
    for i, t in rows():
        n = len(ids[0][i])
        assert result[i] == {"doc_id": i, "n_bytes": len((t or "").encode()), "n_tokens": n, "over_limit": n > 512}


def test_op4(spark, world):
    result = got(spark, world, "op4_language_id", "page_id")
    assert {r["host"] for r in result.values()} == {f"h{k}.example.{s}" for k in range(3) for s in ("com", "fr")} and all(r["lang"] in ("en", "fr") for r in result.values())


def test_op5(spark, world):
    from test_near_and_rules import plain_figures

    for i, r in got(spark, world, "op5_quality_rules").items():
        own = plain_figures(dict(rows())[i])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == own
        failed = own[0] < 20 or 100 * own[4] > 30 * own[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def plain_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return [f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in sorted(out)]


def test_op6(spark, world):
    result, found = got(spark, world, "op6_pii"), 0
    for i, t in rows():
        own = plain_spans(t or "")
        r = result[i]
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(x.startswith(k) for x in own) for k in ("email", "ip", "card", "phone")]
        assert r["base_sha256"] == sha(",".join(own)) and set(own) <= set(r["spans"].split(",") if r["spans"] else [])
        found += len(own)
    assert found >= 6


def test_op7(spark, world, ids):
    result = got(spark, world, "op7_bpe_codec")
    for i, _ in rows():
        own = ids[0][i]
        assert result[i] == {"doc_id": i, "n_tokens": len(own), "ids_sha256": sha(",".join(map(str, own))), "decoded_sha256": sha(ids[1].decode(own, skip_special_tokens=False))}


def test_op8(spark, world):
    prints = {}
    for i, t in rows():
        words = re.findall(BLANK, (t or "").translate(LOWER))
        shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
        h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))
    root = {i: i for i in prints}
    for _ in prints:  # labels fall to the smallest in reach
        for i in prints:
            root[i] = min(root[j] for j in prints if (prints[i] ^ prints[j]).bit_count() <= 2)
    result = got(spark, world, "op8_simhash")
    assert result == {i: {"doc_id": i, "fingerprint": f"{p:016x}", "component_id": root[i]} for i, p in prints.items()}


def test_op9(spark, world, ids):
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in queries.queries()["op9_packing"](spark, world).collect():
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    for i, own in ids[0].items():
        own, at = [*own, 0], 0
        for k, r in enumerate(sorted(pieces[i], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"], r["ids_crc32"]) == (k, at, crc(own[at : at + r["length"]]))
            assert r["length"] == 2048 or k == 0
            at += r["length"]
        assert at == len(own)
    for own in bins.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(bins) <= -(-sum(len(x) + 1 for x in ids[0].values()) // 2048) + 1


def test_op10(spark, world):
    groups = defaultdict(list)
    for i, t in rows():
        groups[(t or "").translate(LOWER)].append(i)
    want = {}
    for t, own in groups.items():
        want |= {i: {"doc_id": i, "keep_id": max(own), "group_size": len(own), "kept": i == max(own), "text_sha256": sha(t)} for i in own}
    assert got(spark, world, "op10_exact_dedup") == want

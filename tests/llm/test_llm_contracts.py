"""The contract columns of queries that SQL doesn't check, against plain computations on whole tables."""

import base64
import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_llm_scans import brute_personal, brute_secrets
from tokenizers import Tokenizer

from clickloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SPACE = r"\x20\x09-\x0D"
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows(spark, name):
    out = {r.doc_id: r for r in QUERIES[name](spark, SF).collect()}
    assert out
    return out


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@pytest.mark.parametrize(
    "name, kinds, brute",
    [
        ("op2_secret_scan", ("assign", "access", "hex"), lambda t: brute_secrets(t)),
        ("op10_personal_data", ("email", "ip", "card", "phone"), lambda t: [(k, a, b) for a, _, b, k in brute_personal(t)]),
    ],
)
def test_spans(spark, texts, name, kinds, brute):
    got = rows(spark, name)
    assert set(got) == set(texts)
    for doc, text in texts.items():
        base, r = brute(text), got[doc]
        assert [r[f"n_{k}"] for k in kinds] == [sum(kind == k for kind, _, _ in base) for k in kinds]
        listed = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == sha(",".join(listed))
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if s.split(":")[0] in kinds] == listed and r.n_spans == len(spans)
        order = (*kinds, "cnn", "likely")
        assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), order.index(s.split(":")[0])))


def test_byte_bpe(spark, texts):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows(spark, "op5_byte_bpe")
    for doc, text in texts.items():
        ids = library.encode_ordinary(text)
        want = (doc, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text))
        assert (doc, got[doc].n_tokens, got[doc].ids_sha256, got[doc].decoded_sha256) == want


def test_token_counts(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    got = rows(spark, "op6_token_counts")
    for doc, text in texts.items():
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert tuple(got[doc]) == (doc, len(text.encode()), n, n > 1024)


PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def test_license_scan(spark, texts):
    got = rows(spark, "op7_license_scan")
    found = 0
    for doc, text in texts.items():
        words = ALNUM.findall(lowered(text))
        at = [(k, label) for phrase, label in PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
        places, r = [k for k, _ in at], got[doc]
        found += len(at)
        assert (r.n_words, r.n_base) == (len(words), len(at))
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if places else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in at}))
        labels = r.labels.split(",") if r.labels else []
        assert labels == sorted(set(labels)) and set(labels) >= {label for _, label in at} and 0 <= r.score <= 1
    assert found


def test_quality_rules(spark, texts):
    got = rows(spark, "op8_quality_rules")
    for doc, text in texts.items():
        words = re.findall(f"[^{SPACE}]+", text)
        places, repeated = {}, set()
        for k in range(len(words) - 7):
            places.setdefault(tuple(words[k : k + 8]), []).append(k)
        for own in places.values():
            if len(own) > 1:
                repeated.update(k + j for k in own for j in range(8))
        seen, dup = set(), 0
        for line in text.split("\n"):
            if re.search(f"[^{SPACE}]", line):
                dup += line in seen
                seen.add(line)
        r = got[doc]
        counts = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (len(words) < 20 or 100 * len(repeated) > 30 * len(words))
        assert not (r.base_failed and r.kept)

"""Private keys are redacted whole."""

import base64
import random

import pyarrow as pa
import pytest

from docsieve.llm import secrets

from .test_operators import frame

BODY = base64.b64encode(random.Random(2).randbytes(400)).decode()
LINES = [BODY[i : i + 64] for i in range(0, len(BODY), 64)]


def key(name, end=True, join="\n", head=()):
    return join.join([f"-----BEGIN {name}-----", *head, *LINES, *([f"-----END {name}-----"] if end else [])])


CASES = {
    "pem": key("PRIVATE KEY"),
    "rsa": key("RSA PRIVATE KEY", join="\r\n"),
    "encrypted": key("EC PRIVATE KEY", head=["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,00FF", ""]),
    "escaped": key("PRIVATE KEY", join="\\n"),
    "indented": key("OPENSSH PRIVATE KEY", join="\n    "),
    "pgp": key("PGP PRIVATE KEY BLOCK", head=["Version: GnuPG v2", ""]),
    "no end": key("PRIVATE KEY", end=False),
    "no end, escaped": key("PRIVATE KEY", end=False, join="\\n"),
    "no end, one line": key("PRIVATE KEY", end=False, join=" "),
    "no end, headers": key("PGP PRIVATE KEY BLOCK", end=False, head=["Version: GnuPG v2", ""]),
    "other end": key("RSA PRIVATE KEY", end=False) + "\n-----END CERTIFICATE-----",
}


@pytest.mark.parametrize("name", CASES)
def test_span_covers_the_key(name):
    index = secrets.Index(secrets.RULES)
    text = f"é before\n{CASES[name]}\nand some words after"
    spans = index.spans(pa.array([text]))[0]
    cut = secrets._cut(text, spans)
    rest = "\n-----END CERTIFICATE-----" if name == "other end" else ""
    assert cut == f"é before\n[PRIVATE_KEY]{rest}\nand some words after"


def test_words_about_keys_stay():
    index = secrets.Index(secrets.RULES)
    text = "The line -----BEGIN PRIVATE KEY----- opens a key, and prose follows it. " * 50
    assert secrets._cut(text, index.spans(pa.array([text]))[0]) == text.replace("-----BEGIN PRIVATE KEY-----", "[PRIVATE_KEY]")
    two = f"{key('PRIVATE KEY', end=False)}\nwords between them\n{key('RSA PRIVATE KEY')}"
    assert secrets._cut(two, index.spans(pa.array([two]))[0]) == "[PRIVATE_KEY]\nwords between them\n[PRIVATE_KEY]"
    public = key("PUBLIC KEY")
    assert not [s for s in index.spans(pa.array([public]))[0] if s[0] == "private_key"]


def test_redaction_leaves_no_key(spark):
    docs = frame(spark, [(i, f"secret = '{t}' rest") for i, t in enumerate(CASES.values())])
    for r in secrets.redact(docs).collect():
        assert not any(x in r.text for x in LINES) and r.text.endswith("rest")

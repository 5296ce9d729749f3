"""The rules for chat tokens, web tokens and bearer headers."""

import pyarrow as pa
import pytest

from docsieve.llm import secrets

WEB = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9P"


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("use xoxb-123456789012-abcdef here", ["chat_token"]),
        ("xoxb-short", []),
        ("xoxz-123456789012", []),
        (f"cookie {WEB} end", ["web_token"]),
        ("eyJhbGci.eyJzdWIi", []),
        ("Authorization: Bearer abcdefghij0123456789+/", ["bearer"]),
        ("BEARER   abcdefghij.0123456789~", ["bearer"]),
        ("a bearer of bad news", []),
    ],
)
def test_rule(text, kinds):
    found = secrets.Index(secrets.RULES).spans(pa.array([f"é {text}", "", "x"]))
    assert sorted({k for k, _, _ in found[0]} & {"chat_token", "web_token", "bearer"}) == kinds
    assert found[1] == found[2] == []
    for kind, start, end in found[0]:
        if kind == "chat_token":
            assert f"é {text}"[start:end] == "xoxb-123456789012-abcdef"
        if kind == "web_token":
            assert f"é {text}"[start:end] == WEB

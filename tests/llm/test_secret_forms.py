"""Keys in the forms that files and code give them are found and masked."""

import base64
import json
import random
import textwrap

import pytest

from tieout.llm import secrets

rng = random.Random(8)


def der(tag, body):
    size = len(body)
    return bytes([tag]) + (bytes([size]) if size < 128 else bytes([0x82]) + size.to_bytes(2, "big")) + body


KEY = der(0x30, b"".join([der(2, b"\0"), *[der(2, rng.randbytes(64)) for _ in range(8)]]))
SSH = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + (1).to_bytes(4, "big") + b"".join(len(x).to_bytes(4, "big") + x for x in (rng.randbytes(51), rng.randbytes(200)))


def b64(data, width=64):
    return "\n".join(textwrap.wrap(base64.b64encode(data).decode(), width))


PEM = f"-----BEGIN RSA PRIVATE KEY-----\n{b64(KEY)}\n-----END RSA PRIVATE KEY-----"
LEGACY = PEM.replace("KEY-----\n", "KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123456789ABCDEF\n\n", 1).replace(b64(KEY), b64(rng.randbytes(640)))
CODE = '"' + PEM.replace("\n", '\\n" +\n    "') + '"'
URL = base64.urlsafe_b64encode(KEY).decode()


@pytest.mark.parametrize(
    "kind, text, inner",
    [
        ("block", PEM, PEM),
        ("block", json.dumps({"private_key": PEM + "\n"}), json.dumps(PEM)[1:-1]),
        ("block", json.dumps(json.dumps({"k": PEM})), json.dumps(json.dumps(PEM))[3:-3]),
        ("block", json.dumps({"k": PEM}).replace("/", "\\/"), json.dumps(PEM)[1:-1].replace("/", "\\/")),
        ("block", PEM.replace("\n", "\r\n"), PEM.replace("\n", "\r\n")),
        ("block", CODE, CODE[1:-1]),
        ("block", LEGACY, LEGACY),
        ("block", json.dumps({"k": LEGACY}), json.dumps(LEGACY)[1:-1]),
        ("keyhex", KEY.hex().upper(), KEY.hex().upper()),
        ("keyhex", KEY.hex()[:99] + KEY.hex()[99:].upper(), KEY.hex()[:99] + KEY.hex()[99:].upper()),
        ("key64", URL, URL),
        ("key64", URL.rstrip("="), URL.rstrip("=")),
        *[("key64", b64(d, w), b64(d, w)) for d in (KEY, SSH) for w in (64, 76)],
        ("key64", b64(KEY).replace("\n", "\\n"), b64(KEY).replace("\n", "\\n")),
        ("key64", b64(KEY).replace("\n", "\r\n  "), b64(KEY).replace("\n", "\r\n  ")),
        ("key64", '"' + b64(KEY).replace("\n", '" +\n "') + '"', b64(KEY).replace("\n", '" +\n "')),
        ("key64", "\n".join(textwrap.wrap(URL, 64)), "\n".join(textwrap.wrap(URL, 64))),
    ],
)
def test_forms_of_keys(kind, text, inner):
    text = f"Some words before\n{text}\nand after it"
    found = [x for x in secrets.spans(text) if x[0] == kind]
    at = text.index(inner)
    assert (kind, at, at + len(inner)) in found
    assert inner not in secrets.redacted(text, secrets.spans(text))
    assert secrets.redacted(text, found) == text[:at] + secrets.MASK + text[at + len(inner) :]


def test_what_is_no_key_stays():
    broken = b64(KEY[:-3] + b"xyzz")
    assert [k for k, _, _ in secrets.spans(f"words\n{broken}\nwords")] == []
    assert secrets.spans(f"-----BEGIN PRIVATE KEY-----\n{broken}\n-----END PRIVATE KEY-----") == []
    assert secrets.spans("-----BEGIN PRIVATE KEY-----\n ENCRYPTED words of prose\n-----END PRIVATE KEY-----") == []
    two = f"-----BEGIN PRIVATE KEY----- cut\n{PEM}"
    assert [(k, s) for k, s, _ in secrets.spans(two) if k == "block"] == [("block", two.index(PEM))]

"""Encoded keys in the forms in which they stand in texts."""
import base64
import textwrap

import numpy as np

from mailcase.llm.secrets import _B64, _HEX, scan

BODY = b"\x02\x01\x00" + b"\x04\x82\x01\x2c" + bytes(i * 7 % 256 for i in range(300))
KEY = b"\x30\x82" + len(BODY).to_bytes(2, "big") + BODY
B64 = base64.b64encode(KEY).decode()


def found(text, kind):
    raw = text.encode()
    part = np.frombuffer(raw, dtype=np.uint8)
    return [raw[s:e].decode() for s, k, e in scan(raw, raw.lower(), _HEX[part], _B64[part]) if k == kind]


def test_base64_glued_to_a_name():
    for name in ("PRIVATE_KEY=", "key=", "path/", "MAMIE_", "a=b=", ""):
        assert found(f"x {name}{B64} y", 4) == [B64], name
    assert found(f"key={B64[:-8]} y", 4) == []


def test_wrapped_base64():
    for width in (64, 76):
        for end in ("\n", "\r\n", "\\n", "\n    "):
            wrapped = end.join(textwrap.wrap(B64, width))
            assert found(f"before\n{wrapped}\nafter it", 4) == [wrapped], (width, end)


def test_hex_of_either_case():
    for text in (KEY.hex(), KEY.hex().upper()):
        assert found(f"k {text} z", 4) == [text]


def test_pem_with_escaped_line_ends_and_headers():
    def pem(body, name="RSA PRIVATE KEY"):
        return f"-----BEGIN {name}-----{body}-----END {name}-----"

    lines = textwrap.wrap(B64, 64)
    headers = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00112233445566778899AABBCCDDEEFF\n\n"
    cipher = base64.b64encode(bytes(i * 91 % 251 for i in range(160))).decode()
    for body in ("\n" + "\n".join(lines) + "\n", "\\n" + "\\n".join(lines) + "\\n",
                 "\nComment: mine\n\n" + "\n".join(lines) + "\n", f"\n{headers}{cipher}\n"):
        assert found(f'"k": "{pem(body)}"', 5) == [pem(body)], body
    assert found(pem("\n" + cipher + "\n"), 5) == []

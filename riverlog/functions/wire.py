"""Byte-level functions: length-delimited protobuf fields, keyframes, access units."""

from __future__ import annotations

import re

#: Start code of a unit, and of an access unit delimiter: fixed values of H.264.
START, DELIMITER = b"\x00\x00\x01", b"\x00\x00\x00\x01\x09"


def _varint(buf: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (buf[i] & 0x7F) << shift
        i += 1
        if not buf[i - 1] & 0x80:
            return value, i
        shift += 7


def _put_varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out + bytes([n]))


def spans(buf: bytes) -> list[tuple[int, int, int, int, int]]:
    """(field, kind, field start, value start, end) of each field; groups and cut-off values are errors."""
    out, i = [], 0
    while i < len(buf):
        start = i
        tag, i = _varint(buf, i)
        field, kind = tag >> 3, tag & 7
        at = i
        if kind == 0:
            _, i = _varint(buf, i)
        elif kind in (1, 5):
            i += 8 if kind == 1 else 4
        elif kind == 2:
            n, at = _varint(buf, i)
            i = at + n
        else:
            raise ValueError(f"wire type {kind}")
        if i > len(buf):
            raise ValueError("cut-off field")
        out.append((field, kind, start, at, i))
    return out


def fields(buf: bytes) -> dict[int, bytes]:
    """Length-delimited fields; of a repeated one the last."""
    return {f: buf[a:b] for f, kind, _, a, b in spans(buf) if kind == 2}


def encode(values: dict[int, bytes]) -> bytes:
    return b"".join(_put_varint(f << 3 | 2) + _put_varint(len(v)) + v for f, v in sorted(values.items()))


def splice(buf: bytes, field: int, value: bytes) -> bytes:
    """buf with one field's value replaced and every other byte as it was."""
    mine = [x for x in spans(buf) if x[0] == field and x[1] == 2]
    new = encode({field: value})
    if not mine:
        return buf + new
    out, at = [], 0
    for k, (_, _, start, _, end) in enumerate(mine):
        out += [buf[at:start], new if k == len(mine) - 1 else b""]
        at = end
    return b"".join([*out, buf[at:]])


def codec_name(name: str) -> str:
    return {"h265": "hevc", "hevc": "hevc", "h264": "h264", "avc": "h264"}.get(name.lower(), name.lower())


def is_keyframe(packet: bytes, codec: str = "h264") -> bool:
    """H.264: a unit of type 5. HEVC: a unit of types 16 to 23, in its own header's place."""
    hevc, i = codec_name(codec) == "hevc", packet.find(START)
    while 0 <= i < len(packet) - 3:
        b = packet[i + 3]
        if (16 <= (b >> 1 & 0x3F) <= 23) if hevc else b & 0x1F == 5:
            return True
        i = packet.find(START, i + 3)
    return False


def access_units(stream: bytes) -> list[bytes]:
    """Parts that start with a delimiter; a stream without one is an error."""
    at = [m.start() for m in re.finditer(re.escape(DELIMITER), stream)]
    if not at:
        raise ValueError("no access unit delimiter")
    return [stream[a:b] for a, b in zip(at, [*at[1:], len(stream)])]

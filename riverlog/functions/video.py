"""Sizes of video streams from their parameter sets, by the public syntax of H.264 and H.265."""

from __future__ import annotations

import re

from riverlog.functions.wire import START, codec_name

#: Unit types of sequence parameter sets, and H.264 profiles that state their chroma format: fixed values of the standards.
SPS_H264, SPS_HEVC = 7, 33
CHROMA_PROFILES = {44, 83, 86, 100, 110, 118, 122, 128, 134, 135, 138, 139, 244}


class Bits:
    def __init__(self, raw: bytes):
        self.value, self.left = int.from_bytes(raw, "big"), 8 * len(raw)

    def take(self, n: int) -> int:
        self.left -= n
        if self.left < 0:
            raise ValueError("cut-off parameter set")
        return self.value >> self.left & (1 << n) - 1

    def number(self) -> int:
        """An Exp-Golomb code."""
        zeros = 0
        while not self.take(1):
            zeros += 1
        return (1 << zeros) - 1 + self.take(zeros)

    def signed(self) -> int:
        n = self.number()
        return (n + 1) // 2 if n % 2 else -(n // 2)


class BitsOut:
    """What Bits reads, for made-up streams."""

    def __init__(self):
        self.bits = ""

    def put(self, n: int, value: int) -> BitsOut:
        self.bits += f"{value:0{n}b}" if n else ""
        return self

    def number(self, value: int) -> BitsOut:
        n = (value + 1).bit_length()
        return self.put(2 * n - 1, value + 1)

    def unit(self, head: bytes) -> bytes:
        """As a unit: closed by a one, and with the bytes put in that keep start codes out of it."""
        bits = self.bits + "1"
        raw = int(bits + "0" * (-len(bits) % 8), 2).to_bytes(-(-len(bits) // 8), "big")
        return b"\x00" + START + head + re.sub(rb"\x00\x00(?=[\x00-\x03])", b"\x00\x00\x03", raw)


def units(packet: bytes) -> list[bytes]:
    """The units of a packet, each with its header, with the bytes taken out that keep start codes out of it."""
    return [u.rstrip(b"\x00").replace(b"\x00\x00\x03", b"\x00\x00") for u in packet.split(START)[1:]]


def _cropped(x: Bits, w: int, h: int, dx: int, dy: int) -> tuple[int, int]:
    if not x.take(1):
        return w, h
    left, right, top, bottom = (x.number() for _ in range(4))
    return w - dx * (left + right), h - dy * (top + bottom)


def _h264(x: Bits) -> tuple[int, int]:
    profile = x.take(24) >> 16
    x.number()
    chroma, apart = 1, 0
    if profile in CHROMA_PROFILES:
        chroma = x.number()
        apart = x.take(1) if chroma == 3 else 0
        x.number(), x.number(), x.take(1)
        if x.take(1):
            for i in range(12 if chroma == 3 else 8):
                if x.take(1):
                    _skip_scaling(x, 16 if i < 6 else 64)
    x.number()
    order = x.number()
    if order == 0:
        x.number()
    elif order == 1:
        x.take(1), x.signed(), x.signed()
        for _ in range(x.number()):
            x.signed()
    x.number(), x.take(1)
    wide, high = x.number() + 1, x.number() + 1
    fields = 2 - x.take(1)
    x.take(fields)  # direct inference, and with fields whether macroblocks adapt
    format_ = 0 if apart else chroma
    return _cropped(x, 16 * wide, 16 * high * fields, 2 if format_ in (1, 2) else 1, (2 if format_ == 1 else 1) * fields)


def _skip_scaling(x: Bits, size: int) -> None:
    last = following = 8
    for _ in range(size):
        if following:
            following = (last + x.signed()) % 256
        last = following or last


def _hevc(x: Bits) -> tuple[int, int]:
    layers = x.take(8) >> 1 & 7
    x.take(96)
    present = [(x.take(1), x.take(1)) for _ in range(layers)]
    x.take(2 * (8 - layers) if layers else 0)
    for profile, level in present:
        x.take(88 * profile + 8 * level)
    x.number()
    chroma = x.number()
    apart = x.take(1) if chroma == 3 else 0
    wide, high = x.number(), x.number()
    format_ = 0 if apart else chroma
    return _cropped(x, wide, high, 2 if format_ in (1, 2) else 1, 2 if format_ == 1 else 1)


def frame_size(packet: bytes, codec: str = "h264") -> tuple[int, int] | None:
    """(width, height) by the packet's first sequence parameter set, None where it has none; a cut-off one is an error."""
    hevc = codec_name(codec) == "hevc"
    for u in units(packet):
        if hevc and len(u) > 2 and u[0] >> 1 & 0x3F == SPS_HEVC:
            return _hevc(Bits(u[2:]))
        if not hevc and len(u) > 1 and u[0] & 0x1F == SPS_H264:
            return _h264(Bits(u[1:]))
    return None


def parameter_set(width: int, height: int, codec: str = "h264") -> bytes:
    """A sequence parameter set of 4:2:0 frames of an even size, for made-up streams."""
    x = BitsOut()
    if codec_name(codec) == "hevc":
        x.put(8, 1).put(96, 0x0160 << 80).number(0).number(1).number(-(-width // 8) * 8).number(-(-height // 8) * 8)
        block, head = 8, b"\x42\x01"
    else:
        x.put(24, 0x4D0028).number(0).number(0).number(2).number(1).put(1, 0).number(-(-width // 16) - 1).number(-(-height // 16) - 1).put(2, 3)
        block, head = 16, b"\x67"
    right, bottom = -width % block, -height % block
    x.put(1, int(bool(right or bottom)))
    if right or bottom:
        x.number(0).number(right // 2).number(0).number(bottom // 2)
    return x.put(8, 0).unit(head)

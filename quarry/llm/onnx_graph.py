"""Graphs for ``onnxruntime``, written in ONNX's wire format (that of protocol
buffers), so that none of ONNX's own tools is needed to make them."""

from __future__ import annotations

import struct

import numpy as np

KINDS = {"float32": 1, "int32": 6, "int64": 7}
IR, OPSET = 8, 17


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | float | str | bytes) -> bytes:
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    value = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _attribute(name: str, value: int | float | list[int]) -> bytes:
    if isinstance(value, list):
        return _field(1, name) + b"".join(_field(8, v) for v in value) + _field(20, 7)
    return _field(1, name) + (_field(2, value) + _field(20, 1) if isinstance(value, float) else _field(3, value) + _field(20, 2))


class Graph:
    """Nodes in the order they are added; a value is known by its name."""

    def __init__(self) -> None:
        self.nodes, self.constants, self.inputs, self.outputs = [], [], [], []

    def input(self, name: str, kind: str, rank: int) -> str:
        self.inputs.append(self._value(name, kind, rank))
        return name

    def output(self, name: str, kind: str, rank: int) -> None:
        self.outputs.append(self._value(name, kind, rank))

    def constant(self, array: np.ndarray) -> str:
        name = f"c{len(self.constants)}"
        array = np.ascontiguousarray(array)
        self.constants.append(b"".join(_field(1, d) for d in array.shape) + _field(2, KINDS[array.dtype.name])
                              + _field(8, name) + _field(9, array.tobytes()))
        return name

    def node(self, kind: str, *inputs: str, to: str = "", domain: str = "", **attributes) -> str:
        to = to or f"n{len(self.nodes)}"
        self.nodes.append(b"".join(_field(1, i) for i in inputs) + _field(2, to) + _field(4, kind)
                          + b"".join(_field(5, _attribute(k, v)) for k, v in attributes.items()) + _field(7, domain))
        return to

    def product(self, a: str, b: str, **turned: int) -> str:
        """Matrix product, of the transposes of the last two axes where told."""
        return self.node("FusedMatMul", a, b, domain="com.microsoft", **turned) if turned else self.node("MatMul", a, b)

    @staticmethod
    def _value(name: str, kind: str, rank: int) -> bytes:
        shape = b"".join(_field(1, _field(2, f"{name}_{d}")) for d in range(rank))
        return _field(1, name) + _field(2, _field(1, _field(1, KINDS[kind]) + _field(2, shape)))

    def model(self) -> bytes:
        graph = b"".join(_field(number, part) for number, parts in (
            (1, self.nodes), (2, ["graph"]), (5, self.constants), (11, self.inputs), (12, self.outputs)) for part in parts)
        opsets = ((_field(1, ""), OPSET), (_field(1, "com.microsoft"), 1))
        return _field(1, IR) + _field(7, graph) + b"".join(_field(8, domain + _field(2, v)) for domain, v in opsets)


def session(model: bytes):
    """The model ready to run, in the thread that asks."""
    import onnxruntime

    options = onnxruntime.SessionOptions()
    options.intra_op_num_threads = options.inter_op_num_threads = 1
    options.log_severity_level = 3
    return onnxruntime.InferenceSession(model, options, providers=["CPUExecutionProvider"])

"""Band expressions as text: a small parser that turns them into Spark columns.

Grammar, from loose to tight: ``c ? a : b``, ``or ||``, ``and &&``, comparisons, ``+ -``, ``* / %``, sign and ``!``, ``^``
(to the right), postfix ``!`` (factorial) and ``%`` where no operand follows (per cent). Names are columns or constants; calls
are those of ``FUNCTIONS``. Nothing of the text reaches Spark's own parser, so an expression can't name anything else.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r"\s*(?:(\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?)|([A-Za-z_]\w*)|(&&|\|\||==|!=|<=|>=|[-+*/%^?:(),<>!]))")
CONSTANTS = {"pi": math.pi, "_pi": math.pi, "e": math.e, "_e": math.e}


def _sum(*x: Column) -> Column:
    out = x[0]
    for c in x[1:]:
        out = out + c
    return out


FUNCTIONS = {
    "abs": F.abs, "sqrt": F.sqrt, "exp": F.exp, "ln": F.ln, "log": F.ln, "log2": F.log2, "log10": F.log10, "sin": F.sin, "cos": F.cos, "tan": F.tan,
    "asin": F.asin, "acos": F.acos, "atan": F.atan, "atan2": F.atan2, "sinh": F.sinh, "cosh": F.cosh, "tanh": F.tanh, "cbrt": F.cbrt, "hypot": F.hypot,
    "floor": F.floor, "ceil": F.ceil, "round": F.round, "trunc": lambda x: F.when(x < 0, F.ceil(x)).otherwise(F.floor(x)), "sign": F.signum, "rint": F.rint, "pow": F.pow,
    "min": lambda *x: F.least(*x) if len(x) > 1 else x[0], "max": lambda *x: F.greatest(*x) if len(x) > 1 else x[0], "sum": _sum, "avg": lambda *x: _sum(*x) / len(x),
    "ndvi": lambda r, n: F.when(r + n == 0, 0.0).otherwise((n - r) / (n + r)),
}


class ExpressionError(ValueError):
    pass


class _Parser:
    def __init__(self, text: str, columns: dict[str, Column]):
        self.columns, self.tokens, at = columns, [], 0
        text = text.rstrip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise ExpressionError(f"unexpected {text[at]!r} at {at}")
            kind = next(k for k in (1, 2, 3) if m.group(k) is not None)
            self.tokens.append((kind, m.group(kind)))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) else None

    def take(self, *texts: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == 3 and self.peek() in texts:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, text: str) -> None:
        if not self.take(text):
            raise ExpressionError(f"expected {text!r}, found {self.peek()!r}")

    def choice(self) -> Column:
        test = self.level(0)
        if self.take("?"):
            yes = self.choice()
            self.need(":")
            return F.when(_truth(test), yes).otherwise(self.choice())
        return test

    LEVELS = (("||",), ("&&",), ("==", "!=", "<", ">", "<=", ">="), ("+", "-"), ("*", "/", "%"))

    def level(self, k: int) -> Column:
        if k == len(self.LEVELS):
            return self.signed()
        left = self.level(k + 1)
        while True:
            if self.peek() == "%" and "%" in self.LEVELS[k] and not self.operand_follows():
                return left
            op = self.take(*self.LEVELS[k])
            if not op:
                return left
            left = _binary(op, left, self.level(k + 1))

    def operand_follows(self) -> bool:
        if self.at + 1 >= len(self.tokens):
            return False
        kind, text = self.tokens[self.at + 1]
        return kind in (1, 2) or text == "("

    def signed(self) -> Column:
        if self.take("-"):
            return -self.signed()
        if self.take("+"):
            return self.signed()
        if self.take("!"):
            return _number(~_truth(self.signed()))
        base = self.postfix()
        return F.pow(base, self.signed()) if self.take("^") else base

    def postfix(self) -> Column:
        out = self.atom()
        while True:
            if self.take("!"):
                out = F.factorial(out.cast("int")).cast("double")
            elif self.peek() == "%" and not self.operand_follows():
                self.at += 1
                out = out / 100
            else:
                return out

    def atom(self) -> Column:
        if self.at >= len(self.tokens):
            raise ExpressionError("unexpected end")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == 1:
            return F.lit(float(text))
        if kind == 2 and self.take("("):
            args = [] if self.peek() == ")" else [self.choice()]
            while self.take(","):
                args.append(self.choice())
            self.need(")")
            if text not in FUNCTIONS:
                raise ExpressionError(f"no function {text!r}")
            try:
                return FUNCTIONS[text](*args)
            except (TypeError, IndexError) as e:
                raise ExpressionError(f"wrong number of arguments for {text!r}") from e
        if kind == 2:
            if text in self.columns:
                return self.columns[text]
            if text in CONSTANTS:
                return F.lit(CONSTANTS[text])
            raise ExpressionError(f"no variable {text!r}")
        if text == "(":
            out = self.choice()
            self.need(")")
            return out
        raise ExpressionError(f"unexpected {text!r}")


def _truth(x: Column) -> Column:
    return x != 0


def _number(x: Column) -> Column:
    return F.when(x, 1.0).otherwise(0.0)


def _binary(op: str, a: Column, b: Column) -> Column:
    if op in ("||", "&&"):
        return _number(_truth(a) | _truth(b) if op == "||" else _truth(a) & _truth(b))
    if op in ("==", "!=", "<", ">", "<=", ">="):
        return _number({"==": a == b, "!=": a != b, "<": a < b, ">": a > b, "<=": a <= b, ">=": a >= b}[op])
    if op == "/":
        return F.when(b == 0, None).otherwise(a / F.when(b == 0, 1.0).otherwise(b))
    if op == "%":
        return F.when(b == 0, None).otherwise(a % F.when(b == 0, 1.0).otherwise(b))
    return {"+": a + b, "-": a - b, "*": a * b}[op]


def parse(text: str, columns: dict[str, Column] | list[str]) -> Column:
    """The column of an expression over named columns; ``a / 0`` is null."""
    named = {c: F.col(c) for c in columns} if isinstance(columns, list) else columns
    p = _Parser(text, {k: v.cast("double") for k, v in named.items()})
    out = p.choice()
    if p.at < len(p.tokens):
        raise ExpressionError(f"unexpected {p.peek()!r}")
    return out


def function_names() -> list[str]:
    return sorted(FUNCTIONS)

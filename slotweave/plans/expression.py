"""Slot expressions compiled to Spark columns.

An expression is ordinary Python expression syntax, read with ``ast``. Only a
whitelist of nodes is understood; everything else is refused, so nothing of a
spec is ever executed as Python. ``{column}`` and ``{table.column}`` refer to
the source row.
"""

from __future__ import annotations

import ast
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotweave.errors import SpecError
from slotweave.functions.identity import uuid5
from slotweave.functions.text import nonblank
from slotweave.functions.values import number, number_text

NON_NUMERIC = "non-numeric value"
DIVISION_BY_ZERO = "division by zero"


@dataclass(frozen=True)
class RowError:
    """A condition that marks a row as failed; it is never null."""

    condition: Column
    message: str


@dataclass(frozen=True)
class Value:
    """A compiled expression: column, type, whether it is raw source text."""

    column: Column
    dtype: T.DataType
    raw: bool = False
    words: bool = False  # a source cell of a column that is known to hold other text than numbers
    errors: tuple[RowError, ...] = ()
    constant: object = None
    number_view: Value | None = field(default=None, compare=False, repr=False)  # kept by as_number

    @property
    def is_number(self) -> bool:
        return isinstance(self.dtype, T.NumericType)

    @property
    def is_text(self) -> bool:
        """Known to be text, as against a source cell that may hold a number."""
        return isinstance(self.dtype, T.StringType) and not self.raw


Resolver = Callable[[str], Value]
SlotFunction = Callable[..., Column]


def as_number(v: Value) -> Value:
    """Numeric view; source text that is no number is a row error."""
    if v.number_view is None:
        if v.is_number:
            view = Value(v.column.cast("double"), T.DoubleType(), errors=v.errors, constant=v.constant)
        else:
            parsed = number(v.column)
            bad = nonblank(v.column.cast("string")) & parsed.isNull()
            view = Value(parsed, T.DoubleType(), errors=(*v.errors, RowError(bad, NON_NUMERIC)))
        object.__setattr__(v, "number_view", view)
    return v.number_view


def as_text(v: Value) -> Column:
    return number_text(v.column, v.dtype)


class ExpressionCompiler:
    """Compiles the expressions of one derivation block."""

    def __init__(self, resolve: Resolver, functions: Mapping[str, SlotFunction] | None = None):
        self._resolve = resolve
        self._functions = dict(functions or {})
        self._declared: T.DataType | None = None
        self._sums: set[int] = set()  # the additions whose result is the slot's value

    def compile(self, text: str, declared: T.DataType | None = None) -> Value:
        """The expression for a slot of the declared type; None where none is declared."""
        try:
            tree = ast.parse(text.strip(), mode="eval")
        except SyntaxError as e:
            raise SpecError(f"cannot parse expression {text!r}: {e.msg}") from e
        names = {n.id for n in ast.walk(tree) if isinstance(n, ast.Name)}
        if "__import__" in names:
            raise SpecError(f"Import expressions are not supported: {text!r}")
        self._declared, self._sums, open_ = declared, set(), [tree.body]
        while open_:
            node = open_.pop()
            if isinstance(node, ast.BinOp) and isinstance(node.op, ast.Add):
                self._sums.add(id(node))
                open_ += [node.left, node.right]
        return self._node(tree.body, text)

    def _node(self, node: ast.expr, text: str) -> Value:
        handler = getattr(self, f"_on_{type(node).__name__.lower()}", None)
        if handler is None:
            raise SpecError(f"{type(node).__name__} expressions are not supported: {text!r}")
        return handler(node, text)

    def _on_constant(self, node: ast.Constant, text: str) -> Value:
        return literal(node.value)

    def _on_name(self, node: ast.Name, text: str) -> Value:
        return self._resolve(node.id)

    def _on_attribute(self, node: ast.Attribute, text: str) -> Value:
        if not isinstance(node.value, ast.Name):
            raise SpecError(f"only table.column references are supported: {text!r}")
        return self._resolve(f"{node.value.id}.{node.attr}")

    def _on_set(self, node: ast.Set, text: str) -> Value:
        if len(node.elts) != 1 or not isinstance(node.elts[0], (ast.Name, ast.Attribute)):
            raise SpecError(f"braces hold exactly one column reference: {text!r}")
        return self._node(node.elts[0], text)

    def _on_unaryop(self, node: ast.UnaryOp, text: str) -> Value:
        v = self._node(node.operand, text)
        if isinstance(node.op, ast.Not):
            return Value(~truth(v), T.BooleanType(), errors=v.errors)
        if not isinstance(node.op, (ast.USub, ast.UAdd)):
            raise SpecError(f"unary {type(node.op).__name__} is not supported: {text!r}")
        v = as_number(v)
        sign = -1 if isinstance(node.op, ast.USub) else 1
        constant = sign * v.constant if isinstance(v.constant, (int, float)) else None
        return Value(-v.column if sign < 0 else v.column, v.dtype, errors=v.errors, constant=constant)

    def _on_binop(self, node: ast.BinOp, text: str) -> Value:
        left, right = self._node(node.left, text), self._node(node.right, text)
        if isinstance(node.op, ast.Add) and (left.is_text or right.is_text or self._joins_words(node, left, right)):
            joined = F.concat(as_text(left), as_text(right))
            return Value(joined, T.StringType(), errors=left.errors + right.errors)
        a, b = as_number(left), as_number(right)
        errors = a.errors + b.errors
        if isinstance(node.op, ast.Add):
            return Value(a.column + b.column, T.DoubleType(), errors=errors)
        if isinstance(node.op, ast.Sub):
            return Value(a.column - b.column, T.DoubleType(), errors=errors)
        if isinstance(node.op, ast.Mult):
            return Value(a.column * b.column, T.DoubleType(), errors=errors)
        if isinstance(node.op, ast.Div):
            if not b.constant:
                zero = F.coalesce(b.column == 0.0, F.lit(False)) & a.column.isNotNull()
                errors += (RowError(zero, DIVISION_BY_ZERO),)
            return Value(F.try_divide(a.column, b.column), T.DoubleType(), errors=errors)
        raise SpecError(f"operator {type(node.op).__name__} is not supported: {text!r}")

    def _joins_words(self, node: ast.BinOp, left: Value, right: Value) -> bool:
        """Whether the sum of two source cells is a text: by the slot's declared type, else by what the columns hold."""
        if not (left.raw and right.raw):
            return False
        if self._declared is not None and id(node) in self._sums:
            return isinstance(self._declared, T.StringType)
        return left.words and right.words

    def _on_compare(self, node: ast.Compare, text: str) -> Value:
        operands = [self._node(n, text) for n in [node.left, *node.comparators]]
        result: Column | None = None
        errors: tuple[RowError, ...] = ()
        for op, a, b in zip(node.ops, operands, operands[1:]):
            if a.is_number or b.is_number:
                x, y = (v.column.cast("double") if v.is_number else number(v.column) for v in (a, b))
            else:
                x, y = as_text(a), as_text(b)
            step = _compare(op, x, y, text)
            result = step if result is None else result & step
            errors += a.errors + b.errors
        return Value(result, T.BooleanType(), errors=errors)

    def _on_boolop(self, node: ast.BoolOp, text: str) -> Value:
        parts = [self._node(n, text) for n in node.values]
        result = truth(parts[0])
        for p in parts[1:]:
            result = result & truth(p) if isinstance(node.op, ast.And) else result | truth(p)
        return Value(result, T.BooleanType(), errors=sum((p.errors for p in parts), ()))

    def _on_ifexp(self, node: ast.IfExp, text: str) -> Value:
        test, yes, no = (self._node(n, text) for n in (node.test, node.body, node.orelse))
        return _branches([(test, yes)], no)

    def _on_call(self, node: ast.Call, text: str) -> Value:
        if not isinstance(node.func, ast.Name) or node.keywords:
            raise SpecError(f"call is not supported: {text!r}")
        name = node.func.id
        if name == "case":
            return self._case(node, text)
        if name == "str":
            (v,) = self._args(node, 1, text)
            return Value(as_text(v), T.StringType(), errors=v.errors)
        if name == "uuid5":
            namespace, v = self._args(node, 2, text)
            if not isinstance(namespace.constant, str):
                raise SpecError(f"the namespace of uuid5 must be a text literal: {text!r}")
            return Value(uuid5(namespace.constant, as_text(v)), T.StringType(), errors=v.errors)
        if name in self._functions:
            args = [self._node(a, text) for a in node.args]
            column = self._functions[name](*[a.column for a in args])
            return Value(column, T.StringType(), raw=True, errors=sum((a.errors for a in args), ()))
        raise SpecError(f"function {name!r} is not registered: {text!r}")

    def _args(self, node: ast.Call, n: int, text: str) -> list[Value]:
        if len(node.args) != n:
            raise SpecError(f"{node.func.id} takes {n} argument(s): {text!r}")
        return [self._node(a, text) for a in node.args]

    def _case(self, node: ast.Call, text: str) -> Value:
        pairs = []
        for arg in node.args:
            if not isinstance(arg, ast.Tuple) or len(arg.elts) != 2:
                raise SpecError(f"case takes (condition, value) pairs: {text!r}")
            pairs.append((self._node(arg.elts[0], text), self._node(arg.elts[1], text)))
        if not pairs:
            raise SpecError(f"case needs at least one pair: {text!r}")
        return _branches(pairs, None)


def literal(value: object) -> Value:
    if value is None:
        return Value(F.lit(None), T.NullType())
    if isinstance(value, bool):
        return Value(F.lit(value), T.BooleanType(), constant=value)
    if isinstance(value, int):
        return Value(F.lit(value).cast("bigint"), T.LongType(), constant=value)
    if isinstance(value, float):
        return Value(F.lit(value), T.DoubleType(), constant=value)
    text = str(value)
    return Value(F.lit(text), T.StringType(), constant=text)


def truth(v: Value) -> Column:
    """The value as a condition; missing counts as false."""
    if isinstance(v.dtype, T.BooleanType):
        condition = v.column
    elif v.is_number:
        condition = v.column != 0
    else:
        condition = nonblank(v.column.cast("string"))
    return F.coalesce(condition, F.lit(False))


def unify(types: list[T.DataType]) -> T.DataType:
    """One type for several values: the same, double for numbers, else text."""
    known = [t for t in types if not isinstance(t, T.NullType)]
    if not known:
        return T.StringType()
    if all(t == known[0] for t in known):
        return known[0]
    if all(isinstance(t, T.NumericType) for t in known):
        return T.DoubleType()
    return T.StringType()


def _branches(pairs: list[tuple[Value, Value]], default: Value | None) -> Value:
    values = [v for _, v in pairs] + ([default] if default else [])
    dtype = unify([v.dtype for v in values])

    def cast(v: Value) -> Column:
        return as_text(v) if isinstance(dtype, T.StringType) else v.column.cast(dtype)

    # An error counts only where its condition or branch is the one taken.
    result, errors, untaken = None, (), F.lit(True)
    for test, value in pairs:
        errors += tuple(RowError(untaken & e.condition, e.message) for e in test.errors)
        condition = truth(test)
        if value.errors:
            taken = untaken & condition
            errors += tuple(RowError(taken & e.condition, e.message) for e in value.errors)
        untaken = untaken & ~condition
        result = F.when(condition, cast(value)) if result is None else result.when(condition, cast(value))
    if default is not None:
        errors += tuple(RowError(untaken & e.condition, e.message) for e in default.errors)
        result = result.otherwise(cast(default))
    return Value(result, dtype, raw=all(v.raw for v in values), errors=errors)


def _compare(op: ast.cmpop, x: Column, y: Column, text: str) -> Column:
    if isinstance(op, ast.Eq):
        return x == y
    if isinstance(op, ast.NotEq):
        return x != y
    if isinstance(op, ast.Lt):
        return x < y
    if isinstance(op, ast.LtE):
        return x <= y
    if isinstance(op, ast.Gt):
        return x > y
    if isinstance(op, ast.GtE):
        return x >= y
    raise SpecError(f"comparison {type(op).__name__} is not supported: {text!r}")

"""SQL expressions shared by the operators that use DataFrame functions only."""


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is computed once a row however often ``body`` uses it.

    A column of a lower projection does not guarantee that: filters that are pushed down, or inferred, copy its
    expression to where it is used, and inside a lambda function that means once an element.
    """
    return f"transform(array({value}), {name} -> {body})[0]"

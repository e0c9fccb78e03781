"""Failure policy of the bulk index sink, as a column rule and as the
same rule on one failure.

A failed request is described by its exception class, the superclasses of
that class (``supers``, the class itself first), the classes of its cause
chain (``causes``, the exception itself first) and its message.  Names may be
package-qualified.  First matching rule wins.  The message tests mirror
``indexOf(..) > 0``: a match at the very start of the message does not count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------
# The store's base exception; its subclasses have it among their supers.
BASE_EXCEPTION = "ElasticsearchException"
CIRCUIT_BREAKING = "type=circuit_breaking_exception"
MAPPER_PARSING = "type=mapper_parsing_exception"
INDEX_NOT_FOUND = "type=index_not_found_exception"
REJECTED = "EsRejectedExecutionException"
SOCKET_TIMEOUT = "SocketTimeoutException"
PARSE_ERROR = "ElasticsearchParseException"
# ---------------------------------------------------------------------------

# (reason, action) in rule order
RULES = [("circuit_breaking", "retry"), ("mapper_parsing", "drop"),
         ("index_not_found", "retry"), ("rejected", "retry"), ("socket_timeout", "log"),
         ("parse_error", "drop"), ("other", "drop")]


def _after_start(msg: Column, needle: str) -> Column:
    return F.coalesce(F.instr(msg, needle) > 1, F.lit(False))


def _names(classes: str, name: str) -> Column:
    """Whether a class list holds ``name``, package-qualified or not."""
    simple = F.transform(F.col(classes), lambda c: F.substring_index(c, ".", -1))
    return F.coalesce(F.array_contains(simple, name), F.lit(False))


def failure_action(supers: str = "supers", causes: str = "causes",
                   message: str = "message") -> tuple[Column, Column]:
    """-> (reason, action) columns; action is retry / drop / log."""
    base = _names(supers, BASE_EXCEPTION)
    msg = F.col(message)
    tests = [base & _after_start(msg, CIRCUIT_BREAKING), base & _after_start(msg, MAPPER_PARSING),
             base & _after_start(msg, INDEX_NOT_FOUND), _names(causes, REJECTED),
             _names(causes, SOCKET_TIMEOUT), _names(causes, PARSE_ERROR)]
    reason = F.lit(RULES[-1][0])
    action = F.lit(RULES[-1][1])
    for test, (r, a) in reversed(list(zip(tests, RULES[:-1]))):
        reason = F.when(test, F.lit(r)).otherwise(reason)
        action = F.when(test, F.lit(a)).otherwise(action)
    return reason, action


def decide(supers: list[str], causes: list[str], message: str | None) -> tuple[str, str]:
    """The rule on one failure, inside a task."""
    def named(classes, name):
        return any(c.rpartition(".")[2] == name for c in classes or ())

    def later(needle):
        return (message or "").find(needle) > 0
    base = named(supers, BASE_EXCEPTION)
    tests = [base and later(CIRCUIT_BREAKING), base and later(MAPPER_PARSING),
             base and later(INDEX_NOT_FOUND), named(causes, REJECTED),
             named(causes, SOCKET_TIMEOUT), named(causes, PARSE_ERROR), True]
    return RULES[tests.index(True)]


def apply_policy(failures: DataFrame) -> DataFrame:
    reason, action = failure_action()
    return failures.withColumn("reason", reason).withColumn("action", action)


def dead_letters(classified: DataFrame) -> DataFrame:
    """Requests the policy gives up on (logged and dropped)."""
    return classified.where(F.col("action") == "drop")

"""XML namespaces of a document as text: which elements belong to a given namespace.

Spark's XML parser knows element names as they are written. These expressions read the
declarations of the root element and rewrite the names of a document, so that exactly
the elements of one namespace have their plain local names, however they were
spelled: a default namespace, a prefix, or several prefixes of the same namespace.

Declarations below the root would bind names differently inside; such documents are
reported rather than misread.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME = r"[A-Za-z_][\w.\-]*"
_BEFORE_ROOT = r"^\x{FEFF}?\s*(?:<\?.*?\?>\s*|<!--.*?-->\s*|<!DOCTYPE[^>]*>\s*)*"
_DECLARATION = r"\sxmlns(?::" + NAME + r")?\s*="
OTHER = "other..."  # prefixed to names outside the namespace; no element of a schema is called so


def root_tag(document: Column) -> Column:
    """The start tag of the root element ('': there is none)."""
    return F.regexp_extract(document, f"(?s){_BEFORE_ROOT}(<(?:{NAME}:)?{NAME}[^>]*>)", 1)


def bound_prefixes(root: Column, namespace: str) -> Column:
    """Prefixes that the root tag binds to ``namespace`` ('': it is the default)."""
    value = re.escape(namespace)
    return F.regexp_extract_all(root, F.lit(rf"\sxmlns(?::({NAME}))?\s*=\s*[\"']{value}[\"']"), F.lit(1))


def root_prefix(root: Column) -> Column:
    return F.regexp_extract(root, f"^<(?:({NAME}):)?{NAME}", 1)


def root_problem(document: Column, root: Column, namespace: str) -> Column:
    """Why a document's elements cannot be told apart or are not ours (null: they are)."""
    below = F.regexp_count(document, F.lit(_DECLARATION)) > F.regexp_count(root, F.lit(_DECLARATION))
    ours = F.array_contains(bound_prefixes(root, namespace), root_prefix(root))
    return (F.when(document.isNull() | (root == ""), "malformed record")
            .when(below, "namespace declared below the root")
            .when(~ours, "foreign namespace"))


def in_namespace(document: Column, root: Column, namespace: str) -> Column:
    """The document with plain names for the elements of ``namespace`` and no other plain names."""
    bound = bound_prefixes(root, namespace)
    own = F.array_remove(bound, "")
    # Without a default namespace of ours, names without a prefix belong to others.
    others = F.when(F.array_contains(bound, ""), document).otherwise(
        F.regexp_replace(document, f"<(/?)({NAME})(?=[\\s/>])", f"<$1{OTHER}$2"))
    prefixes = F.array_join(F.transform(own, lambda p: F.concat(F.lit(r"\Q"), p, F.lit(r"\E"))), "|")
    return F.when(F.size(own) == 0, others).otherwise(
        F.regexp_replace(others, F.concat(F.lit("<(/?)(?:"), prefixes, F.lit("):")), F.lit("<$1")))

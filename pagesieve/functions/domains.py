"""Registrable domain of a host name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The suffixes of two labels below which names are registered.
TWO_LABEL_SUFFIXES = (
    ".hb.cn", ".net.cn", ".com.cn", ".yn.cn", ".ha.cn", ".he.cn",
    ".com.au", ".nx.cn", ".sd.cn", ".sn.cn", ".ah.cn", ".bj.cn",
    ".gx.cn", ".hl.cn", ".gd.cn", ".ac.cn", ".gs.cn", ".xj.cn",
    ".sc.cn", ".ln.cn", ".hk.cn", ".zj.cn", ".gov.cn", ".edu.cn",
    ".cn.com", ".hn.cn", ".gz.cn", ".js.cn", ".com.hk", ".sh.cn",
    ".fj.cn", ".nm.cn", ".net.au", ".mo.cn", ".tj.cn", ".jx.cn",
    ".jl.cn", ".qh.cn", ".cq.cn", ".org.cn", ".xz.cn", ".hi.cn",
    ".tw.cn", ".com.tw", ".sx.cn", ".com.mo",
)


def top_domain(domain: Column) -> Column:
    """One label and its suffix: a listed one of two labels, else the last label.

    Suffixes all have two labels, so at most one can match and one anchored pattern serves.
    A name whose only dot comes first keeps just what follows it.
    """
    listed = "|".join(suffix.replace(".", r"\.") for suffix in TWO_LABEL_SUFFIXES)
    by_suffix = F.regexp_extract(domain, rf"([^.]*(?:{listed}))\z", 1)
    lone_dot = domain.rlike(r"\A\.[^.]*\z")
    return (
        F.when(by_suffix != "", by_suffix)
        .when(lone_dot, F.substr(domain, F.lit(2)))
        .otherwise(F.substring_index(domain, ".", -2))
    )


def host_of(url: Column) -> Column:
    """Host name of a URL; NULL when it has none."""
    return F.try_parse_url(url, F.lit("HOST"))

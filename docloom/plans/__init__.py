"""Registered queries: each operator applied to tables derived from the supplied corpus."""

from docloom.plans import answers, corpus, enrichment, extraction, graph, overlay, prose, teaching

QUERIES, ORACLES = {}, {}
for _module in (corpus, extraction, graph, enrichment, overlay, teaching, prose, answers):
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.ORACLES)

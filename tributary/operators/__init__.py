"""DataFrame operators: framing, envelopes, events, predicates, de-duplication, feeds."""

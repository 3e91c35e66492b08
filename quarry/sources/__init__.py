"""Readers, sinks and fixture derivations. Logic never depends on where rows come from."""

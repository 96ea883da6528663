"""Training-data operators: near/exact/substring/suffix dedup, language id, fingerprints,
tokenising, LM scoring, packing and sharding. Nothing outside this folder imports it."""

"""Event encoding, decoding, and landing of micro-batches."""

"""Landing areas, page envelopes and raw tables."""

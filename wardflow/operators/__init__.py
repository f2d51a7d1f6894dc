"""Frame-to-frame operators: messages, segments, quality, facts, census, forecast."""

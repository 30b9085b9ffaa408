"""Click stream: decoding, routing, time-to-live state."""

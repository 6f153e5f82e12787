"""Writers: exports, topic messages, target table, snapshot switch."""

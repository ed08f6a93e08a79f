"""Tables: writes, upserts, compaction, clustering, detail."""

"""Page tables: landing, layout, snapshots and rendered test pages."""

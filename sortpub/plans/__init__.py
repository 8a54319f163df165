"""Plans over the driver's tables: input views, registered queries, end-to-end run."""

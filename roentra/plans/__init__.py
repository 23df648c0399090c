"""Jobs: sources -> operators -> one write per table, plus an audit row."""

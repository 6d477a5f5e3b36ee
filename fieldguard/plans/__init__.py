"""Plans for host units: log calls and records, spans, contexts, tool and resource results."""

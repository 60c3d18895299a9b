"""DataFrame operators: documents, postings, query terms, matching, ranking, results, maintenance."""

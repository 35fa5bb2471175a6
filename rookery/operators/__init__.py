"""DataFrame-to-DataFrame operators, each defined over all users at once."""

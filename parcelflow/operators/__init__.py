"""DataFrame operators on listings: decode, time, summarise, look up, check, route."""

"""DataFrame in, DataFrame out: free of sources, sinks and clocks."""

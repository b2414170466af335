"""factloom: filing-fact analytics and corpus preparation as Spark jobs."""

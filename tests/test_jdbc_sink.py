"""JDBC sink: option plumbing only (no database may run in this environment)."""

from pitchside.sinks.jdbc import write_jdbc


class _Writer:
    def __init__(self):
        self.calls = []

    def mode(self, m):
        self.calls.append(("mode", m))
        return self

    def jdbc(self, url, table, properties):
        self.calls.append(("jdbc", url, table, dict(properties)))


class _Frame:
    def __init__(self):
        self.write = _Writer()


def test_write_jdbc_passes_parallelism_and_batching():
    df = _Frame()
    write_jdbc(df, "jdbc:postgresql://db/x", "team_info", {"user": "u"}, mode="overwrite",
               batch_size=5000, num_connections=8)
    assert df.write.calls[0] == ("mode", "overwrite")
    _, url, table, props = df.write.calls[1]
    assert (url, table) == ("jdbc:postgresql://db/x", "team_info")
    assert props == {"user": "u", "batchsize": "5000", "numPartitions": "8", "truncate": "true"}

"""Datasets in a shared folder: create, load, build, read and delete.

A dataset is a folder with a small append-only log and versioned parquet tables. A table counts
only once the log names it, so a failed load or build leaves nothing visible behind.
"""

from __future__ import annotations

import datetime as dt
import json
import warnings
from collections import namedtuple
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from corpusmap.functions import text, vectors
from corpusmap.operators import checks, duplicates, embed, knn, projection, rows, schema, tag_blocks, tags, tiles, topics
from corpusmap.plans import options as opts
from corpusmap.sources import columns, records, sinks

ROW_ID = "_row_id"
# Folders that stored ids are dealt to by hash; a load opens only those that its own ids fall into.
ID_SLOTS = 64
Entry = namedtuple("Entry", "seq kind at payload")


class Dataset:
    """A named row store of one modality; open an existing one or ``create`` it."""

    def __init__(self, spark: SparkSession, root: str, identifier: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/{identifier.strip('/')}"
        self.identifier = identifier
        created = self._last("create")
        if created is None:
            raise ValueError(f"no dataset {identifier!r} in {root}")
        self.modality: str = created["modality"]
        self.id_field: str | None = created["id_field"]
        self.description: str = created["description"]

    @classmethod
    def create(
        cls, spark: SparkSession, root: str, identifier: str, *, modality: str, id_field: str | None = None,
        description: str = "",
    ) -> "Dataset":
        if modality not in schema.MODALITIES:
            raise ValueError(f"modality must be one of {schema.MODALITIES}")
        self = cls.__new__(cls)
        self.spark, self.identifier = spark, identifier
        self.path = f"{root.rstrip('/')}/{identifier.strip('/')}"
        record = {"modality": modality, "id_field": id_field, "description": description}
        self._log("create", record)
        return cls(spark, root, identifier)

    # The log: one small JSON record per event.

    def _log(self, kind: str, payload: dict, after: int | None = None) -> None:
        """Add a record under the next number. Its file must not exist yet, so of two writers one fails.

        With ``after``, rows must not have changed since that record, as what is logged was worked out from them.
        """
        entries = self._entries()
        if after is not None and any(e.seq > after and e.kind in ("load", "replace", "drop") for e in entries):
            raise RuntimeError("another writer changed the rows of this dataset")
        record = Entry(entries[-1].seq + 1 if entries else 0, kind, dt.datetime.now(dt.timezone.utc).isoformat(), json.dumps(payload))
        files, folder = self._log_files()
        out = files.create(self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"{record.seq:010d}.json"), False)
        try:
            out.write(json.dumps(record._asdict()).encode())
        finally:
            out.close()

    def _log_files(self):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/log")
        return folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), folder

    def _entries(self) -> list[Entry]:
        """All records in order. They never change, so each is read once."""
        files, folder = self._log_files()
        if not files.exists(folder):
            return []
        read = self.__dict__.setdefault("_read", {})
        for status in files.listStatus(folder):
            place = status.getPath()
            name = place.getName()
            if name in read or not name.endswith(".json"):
                continue
            stream = files.open(place)
            try:
                text_ = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if text_:  # otherwise a writer has just begun it
                read[name] = Entry(**json.loads(text_))
        return [read[name] for name in sorted(read)]

    @classmethod
    def exists(cls, spark: SparkSession, root: str, identifier: str) -> bool:
        """Whether a dataset of that name was created and not dropped since."""
        self = cls.__new__(cls)
        self.spark, self.path = spark, f"{root.rstrip('/')}/{identifier.strip('/')}"
        return bool(self._payloads("create"))

    def _payloads(self, kind: str) -> list[dict]:
        """Records of a kind since the last drop, which ends a dataset and all it held."""
        live: list = []
        for e in self._entries():
            live = [] if e.kind == "drop" else [*live, e]
        return [json.loads(e.payload) for e in live if e.kind == kind]

    def _last(self, kind: str) -> dict | None:
        found = self._payloads(kind)
        return found[-1] if found else None

    # Rows.

    @property
    def _loads(self) -> list[str]:
        """Folders of the current generation of rows."""
        current: list[str] = []
        for e in self._entries():
            if e.kind == "load":
                current.append(json.loads(e.payload)["path"])
            elif e.kind == "replace":
                current = [json.loads(e.payload)["path"]]
            elif e.kind == "drop":
                current = []
        return current

    @property
    def schema(self) -> T.StructType | None:
        first = self._last("schema")
        return None if first is None else T.StructType.fromJson(first)

    @property
    def key(self) -> str:
        return self.id_field or ROW_ID

    @property
    def data(self) -> DataFrame:
        loads = self._loads
        if not loads:
            raise ValueError("the dataset has no rows")
        return self.spark.read.schema(self.schema).parquet(*loads)

    @property
    def total_datums(self) -> int:
        return self.data.count() if self._loads else 0

    @property
    def fields(self) -> list[str]:
        return [f for f in (self.schema.names if self.schema else []) if f != ROW_ID]

    @property
    def created_timestamp(self) -> dt.datetime:
        last = [e for e in self._entries() if e.kind == "create"][-1]
        return dt.datetime.fromisoformat(last.at)

    def add_data(self, data=None, embeddings=None, blobs: DataFrame | None = None, batch: tuple[str, int] | None = None) -> None:
        """Validate rows and append them; rows whose id is stored already are skipped.

        ``embeddings`` is a table of the id field and ``vector``, or an array for local rows.
        ``blobs`` is a table of the id field and ``content``; the bytes are stored once per hash.
        ``batch`` names a stream and its micro-batch. It is logged by the record that makes the rows visible, so a batch
        that comes again after a failure is either stored wholly, and skipped, or not at all.
        """
        if batch is not None and list(batch) in [p.get("batch") for p in self._payloads("load")]:
            return
        began = self._entries()[-1].seq
        df = self._with_vectors(data, embeddings)
        if blobs is not None:
            hashed = blobs.select(self.id_field, records.blob_hash(F.col("content")).alias("_blob_hash"))
            df = records.attach_blobs(df, hashed, self.id_field)
        load = len(self._payloads("load"))
        if self.id_field is None:
            number = F.concat_ws("-", F.lit(str(load)), F.monotonically_increasing_id().cast("string"))
            df = df.withColumn("row_number_", number)
        stored = self.schema
        if stored is None:
            clean = schema.coerce(df, self.modality, self.id_field)
        else:
            clean = schema.conform(df.withColumnRenamed("row_number_", ROW_ID), stored)
        clean = schema.fill_null_strings(clean, self.id_field).withColumnRenamed("row_number_", ROW_ID)
        if stored is not None and self.id_field is not None and self._loads:
            clean = rows.new_rows(clean, self._stored_ids(clean), self.id_field)
        elif self.id_field is not None:  # a first load, too, stores one row per id
            clean = clean.dropDuplicates([self.id_field])
        path = f"{self.path}/rows/load-{load}-{dt.datetime.now().strftime('%H%M%S%f')}"
        # rules are evaluated by the job that writes; what broke one is deleted and never named
        rules, later = self._rules(), bool(stored is not None and self._loads)
        seen_rows, seen = checks.watched(clean, rules)
        sinks.append_shards(seen_rows, path)
        problems = self._problems(checks.broken(seen, rules), self.spark.read.schema(clean.schema).parquet(path), later)
        if problems:
            self._delete(path)
            raise checks.RowError(problems)
        if stored is None:
            self._log("schema", json.loads(clean.schema.json()))
        if blobs is not None:
            content = blobs.select(records.blob_hash(F.col("content")).alias("_blob_hash"), "content").filter("content is not null")
            sinks.write_version(content.dropDuplicates(["_blob_hash"]), f"{path}-blobs")
            self._log("blobs", {"path": f"{path}-blobs"})
        written = self.spark.read.schema(clean.schema).parquet(path)
        self._log("load", {"path": path, "ids": self._write_ids(written, path), "batch": batch}, began)

    def _slot(self):
        return F.expr(f"cast(pmod(xxhash64(`{self.id_field}`), {ID_SLOTS}) as int)").alias("slot")

    def _write_ids(self, written: DataFrame, path: str) -> str | None:
        """The ids of a load or generation, in folders by slot; rows with made-up ids need none."""
        if self.id_field is None:
            return None
        dealt = written.select(self.id_field, self._slot()).repartition("slot")
        dealt.write.mode("error").partitionBy("slot").option("compression", "zstd").parquet(f"{path}-ids")
        return f"{path}-ids"

    def _stored_ids(self, arriving: DataFrame) -> DataFrame:
        """Stored ids of the slots that arriving ids fall into."""
        slots = [r.slot for r in arriving.select(self._slot()).distinct().collect()]  # at most ID_SLOTS numbers
        kind = T.StructType([self.schema[self.id_field], T.StructField("slot", T.IntegerType())])
        known = self.spark.createDataFrame([], kind)
        for path in self._id_folders():
            known = known.unionByName(self.spark.read.schema(kind).parquet(path))
        return known.filter(F.col("slot").isin(slots)).select(self.id_field)

    def _id_folders(self) -> list[str]:
        current: list[str] = []
        for e in self._entries():
            if e.kind == "drop":
                current = []
            elif e.kind in ("load", "replace"):
                current = [*(current if e.kind == "load" else []), json.loads(e.payload)["ids"]]
        return current

    @property
    def blobs(self) -> DataFrame:
        """``_blob_hash, content``: the stored bytes, one row per hash."""
        paths = [p["path"] for p in self._payloads("blobs")]
        if not paths:
            return self.spark.createDataFrame([], "_blob_hash string, content binary")
        return self.spark.read.schema("_blob_hash string, content binary").parquet(*paths).dropDuplicates(["_blob_hash"])

    def _with_vectors(self, data, embeddings) -> DataFrame:
        if isinstance(embeddings, np.ndarray):
            if embeddings.ndim != 2 or not embeddings.size:
                raise ValueError("embeddings must be a non-empty 2-D array")
            if isinstance(data, DataFrame):
                raise TypeError("a table needs its vectors as a table: positions are not stable")
            local = [{} for _ in embeddings] if data is None else _records(data)
            if len(local) != len(embeddings):
                raise ValueError("rows and embeddings differ in number")
            data = [{**r, "_embeddings": [float(x) for x in v]} for r, v in zip(local, embeddings)]
            kept = records.ingest(self.spark, data)
            return kept.withColumn("_embeddings", F.col("_embeddings").cast("array<float>"))
        if embeddings is None:
            return records.ingest(self.spark, data)
        if data is None:
            return embeddings.withColumnRenamed("vector", "_embeddings")
        return records.attach_vectors(records.ingest(self.spark, data), embeddings, self.id_field, "vector")

    def _rules(self) -> list:
        """What rows of a load must meet."""
        found = list(checks.id_rules(self.id_field)) if self.id_field else []
        return found + (checks.vector_rules("_embeddings") if self.modality == "embedding" else [])

    def _problems(self, broken: list, written: DataFrame, later: bool) -> list:
        """The broken rules; a later load may be empty, and its vectors have the dimension of those stored before."""
        if self.modality != "embedding" or not later:
            return broken
        broken = [b for b in broken if b[0] != "no rows"]
        held, new = (df.select(F.size("_embeddings")).first() for df in (self.data, written))
        if not broken and new is not None and held[0] != new[0]:
            return [("dimension differs", "_embeddings", new[0])]
        return broken

    def _delete(self, path: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)

    def get_data(self, ids) -> DataFrame:
        return rows.by_ids(self.data, ids, self.key)

    def delete_data(self, ids) -> None:
        """Write a new generation of the rows without ids. Maps change at the next build."""
        began = self._entries()[-1].seq
        path = f"{self.path}/rows/without-{dt.datetime.now().strftime('%Y%m%d%H%M%S%f')}"
        sinks.append_shards(rows.without_ids(self.data, ids, self.key), path)
        left = self.spark.read.schema(self.schema).parquet(path)
        self._log("replace", {"path": path, "ids": self._write_ids(left, path)}, began)

    def drop(self) -> None:
        self._log("drop", {})

    def stale(self, now: dt.datetime, delay: int) -> bool:
        """Whether rows changed since the newest build, and that began at least ``delay`` seconds before ``now``.

        Both are read from the log, so any session that opens the dataset keeps to the same pause.
        """
        entries = self._entries()
        changes, builds = ([e for e in entries if e.kind in kinds] for kinds in (("load", "replace"), ("build",)))
        if not changes or not builds:
            return bool(changes)
        began = dt.datetime.fromisoformat(json.loads(builds[-1].payload)["began"])
        seen = json.loads(builds[-1].payload)["seen"]
        return changes[-1].seq > seen and (now - began).total_seconds() >= delay

    # Builds.

    def create_index(
        self, name: str | None = None, indexed_field: str | None = None, *, topic_model=None, duplicate_detection=None,
        projection_options=None, embedder: embed.Embedder | None = None, reuse_from: "Map | None" = None,
        tile_rows: int = tiles.TILE_ROWS, embedding_options=None,
    ) -> "Map":
        """Embed, lay out, tile, model topics and find duplicates; each result is a table of the build.

        With ``embedding_options`` that name a chunk length, texts are embedded piece by piece and the unit vectors of the
        pieces pooled to one. Texts and tokens that the embedder took are counted by the job that writes the vectors.
        """
        how_embedding = opts.read(embedding_options, opts.EmbeddingOptions)
        how_topics = opts.read(topic_model, opts.TopicOptions, "build_topic_model")
        how_duplicates = opts.read(duplicate_detection, opts.DuplicateOptions, "tag_duplicates")
        how_projection = opts.read(projection_options, opts.ProjectionOptions)
        notes = []
        if self.modality == "text":
            if indexed_field is None:
                raise ValueError("a text dataset needs an indexed_field")
            if indexed_field not in self.fields:
                raise ValueError(f"indexed_field {indexed_field!r} is not a field of the dataset")
        elif self.modality == "image":
            if indexed_field not in (None, "_blob_hash"):
                notes.append("indexed_field ignored for images")
            if embedder is None:
                raise ValueError("images need an embedder")
            indexed_field = "_blob_hash"
        label_field = how_topics.topic_label_field or (indexed_field if self.modality == "text" else None)
        if label_field is not None and label_field not in self.fields:
            raise ValueError(f"topic_label_field {label_field!r} is not a field of the dataset")
        if self.modality == "image" and label_field is None and how_topics.build_topic_model:
            how_topics = opts.TopicOptions(build_topic_model=False)
            notes.append("no topics for images without a label field")
        for note in notes:
            warnings.warn(note, stacklevel=2)

        number, seen = len(self._payloads("build")), self._entries()[-1].seq
        began = dt.datetime.now(dt.timezone.utc).isoformat()
        folder = f"{self.path}/builds/{number}-{dt.datetime.now().strftime('%H%M%S%f')}"
        data, key = self.data, F.col(self.key).alias("id")

        def keep(table: str, df: DataFrame) -> DataFrame:
            path = f"{folder}/{table}"
            sinks.write_version(df, path)
            return self.spark.read.schema(df.schema).parquet(path)

        # Tables keyed by id are column groups: bucketed alike, so that readers join them without a shuffle.
        buckets, groups = columns.buckets_for(data.count()), {}

        def keep_group(table: str, df: DataFrame) -> DataFrame:
            path = f"{folder}/{table}"
            columns.write_group(df, path, buckets)
            groups[table] = json.loads(df.schema.json())
            return self.spark.read.schema(df.schema).parquet(path)

        embedded, taken = self._embed(data, key, indexed_field, embedder, reuse_from, how_embedding)
        points = keep_group("embeddings", embedded).select("id", "vector")
        usage = {"model": how_embedding.model, "texts": 0, "total_tokens": 0} | (taken.get if taken else {})

        def lay_out() -> list[str]:
            graph = keep("neighbors", knn.neighbor_graph(points, how_projection.n_neighbors, metric="cosine"))
            located = keep_group("projected", projection.project(points, how_projection, graph))
            sinks.write_tiles(tiles.quadtree(located, tile_rows), f"{folder}/tiles")
            keep_group("seats", tag_blocks.seat_rows(self.spark.read.parquet(f"{folder}/tiles")))
            return ["neighbors", "projected", "tiles", "seats"]

        def copy_fields() -> list[str]:
            # what the build indexed is long and seldom wanted, so it stands apart
            others = [f for f in self.fields if f not in (self.key, indexed_field, "_embeddings") and f.lower() != "id"]
            parts = {"fields": others, "indexed": [indexed_field] if self.modality == "text" and indexed_field != self.key else []}
            for table, part in parts.items():
                if part:
                    keep_group(table, data.select(key, *[F.col(f"`{f}`") for f in part]))
            return [table for table, part in parts.items() if part]

        def model_topics() -> list[str]:
            if not how_topics.build_topic_model:
                return []
            texts = None if label_field is None else data.select(key, F.col(label_field).cast("string").alias("text"))
            coded, meta = topics.build_topics(
                points, texts, how_topics.sizes, enforce_hierarchy=how_topics.enforce_topic_hierarchy,
                cluster_method=how_topics.cluster_method,
            )
            keep_group("topics", coded)
            keep("topic_metadata", meta)
            return ["topics", "topic_metadata"]

        def mark_duplicates() -> list[str]:
            if not how_duplicates.tag_duplicates:
                return []
            keep_group("duplicates", duplicates.find_duplicates(points, how_duplicates.duplicate_cutoff))
            return ["duplicates"]

        # Independent chains of jobs share the cluster.
        built, chains = ["embeddings"], (lay_out, model_topics, mark_duplicates, copy_fields)
        with ThreadPoolExecutor(len(chains)) as pool:
            chains = [pool.submit(inheritable_thread_target(self.spark)(f)) for f in chains]
            for chain in chains:
                built += chain.result()
        stored = {"buckets": buckets, "groups": groups, "began": began, "seen": seen}
        self._log("build", {"name": name or self.identifier, "path": folder, "tables": built, "notes": notes, "usage": usage} | stored)
        return Map(self, number)

    def _embed(self, data, key, field, embedder, reuse_from, how) -> tuple[DataFrame, Observation | None]:
        """``id, text_hash, vector``, and what the embedder takes of it, known once that is written."""
        if self.modality == "embedding":
            v = vectors.doubles(F.col("_embeddings"))
            return data.select(key, F.lit(None).cast("string").alias("text_hash"), v.alias("vector")), None
        texts = data.select(key, F.col(field).alias("text"))
        hashed = texts.withColumn("text_hash", embed.text_hash(F.col("text")))
        fresh, kept = hashed, None
        if reuse_from is not None:
            earlier = reuse_from.table("embeddings").select("id", "text_hash", "vector")
            kept = hashed.join(earlier, ["id", "text_hash"])
            fresh = hashed.join(earlier, ["id", "text_hash"], "left_anti")
        taken = Observation()
        if self.modality == "image":
            met = fresh.join(self.blobs.withColumnRenamed("_blob_hash", "text"), "text").observe(taken, F.count(F.lit(1)).alias("texts"))
            done = met.withColumn("vector", embedder(F.col("content")))
        else:
            tokens = F.coalesce(F.sum(F.coalesce(F.size(text.tokens(F.col("text"))), F.lit(0)).cast("bigint")), F.lit(0))
            counts = [F.count(F.lit(1)).alias("texts"), tokens.alias("total_tokens")]
            fresh = fresh.withColumn("text", F.coalesce("text", F.lit("")))
            if how.chunk_chars:
                pieces = embed.char_chunks(fresh, "text", how.chunk_chars).observe(taken, *counts)
                pooled = embed.pool_chunks(embed.embed_text(pieces, embedder=embedder, output="vector"), "id", "vector")
                done = fresh.select("id", "text_hash").join(pooled, "id")
            else:
                done = embed.embed_text(fresh.observe(taken, *counts), embedder=embedder, output="vector")
        columns = ["id", "text_hash", "vector"]
        done = done.select(*columns)
        return (done if kept is None else done.unionByName(kept.select(*columns))), taken

    @property
    def maps(self) -> list["Map"]:
        return [Map(self, i) for i in range(len(self._payloads("build")))]

    def get_map(self, name: str | None = None) -> "Map":
        """The newest map, or the newest of a name."""
        for i, build in reversed(list(enumerate(self._payloads("build")))):
            if name is None or build["name"] == name:
                return Map(self, i)
        raise ValueError("no such map")


def _records(data) -> list[dict]:
    if isinstance(data, list):
        return data
    return data.to_pylist() if hasattr(data, "to_pylist") else data.to_dict(orient="records")


class Map:
    """One build: every result is a DataFrame keyed by ``id``."""

    def __init__(self, dataset: Dataset, number: int):
        self.dataset = dataset
        build = dataset._payloads("build")[number]
        self.name, self.path, self.tables, self.notes = (build[k] for k in ("name", "path", "tables", "notes"))
        #: Model, texts and tokens that the embedder took for this build; re-used vectors count nothing.
        self.usage: dict = build.get("usage", {})
        self._buckets: int = build["buckets"]
        self._groups = {name: T.StructType.fromJson(found) for name, found in build["groups"].items()}

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise ValueError(f"the map was built without {name}")
        return self.dataset.spark.read.parquet(f"{self.path}/{name}")

    def group(self, name: str) -> DataFrame:
        """A table of the build keyed by ``id``, read by its buckets."""
        if name not in self._groups:
            raise ValueError(f"the map was built without {name}")
        return columns.read_group(self.dataset.spark, f"{self.path}/{name}", self._groups[name], self._buckets)

    def data(self, fields: list[str] | None = None) -> DataFrame:
        """Rows of the map, as they were when it was built, with the wanted fields.

        Fields are those of the dataset, then places (``x, y``), ``cluster_id``, ``duplicate_class`` and topic labels
        (``topic_depth_1..n``) as far as the map has them. Only groups that hold a wanted field are opened, of these only
        the wanted columns, and their buckets are merged without a shuffle.
        """
        key, owners = self.dataset.key, {}
        for name in ("fields", "indexed", "projected", "duplicates", "topics"):
            for field in self._groups[name].names if name in self._groups else []:
                owners.setdefault(field, name)
        wanted = [f for f in self.dataset.fields if f in owners or f == key] if fields is None else list(fields)
        missing = [("unknown field", f) for f in wanted if f not in owners and f not in (key, "id")]
        if missing:
            raise schema.SchemaError(missing)
        wanted = [f for f in dict.fromkeys(wanted) if f != "id"]
        opened = []
        for name in dict.fromkeys([owners[f] for f in wanted if f != key] or ["projected"]):
            part = self.group(name).select("id", *[F.col(f"`{f}`") for f in wanted if owners.get(f) == name])
            opened.append(topics.label_topics(part, self.topic_metadata) if name == "topics" else part)
        return columns.join_groups(opened).select("id", *[F.col("id").alias(key) if f == key else F.col(f"`{f}`") for f in wanted])

    # Vectors.

    @property
    def latent(self) -> DataFrame:
        return self.table("embeddings").select("id", "vector")

    @property
    def projected(self) -> DataFrame:
        return self.table("projected")

    def vector_search(self, queries: DataFrame | None = None, ids=None, k: int = 5, metric: str = "l2") -> DataFrame:
        """Nearest rows of query vectors (``id, vector``) or of rows named by id."""
        if (queries is None) == (ids is None):
            raise ValueError("give either queries or ids")
        if queries is not None:
            return knn.search_by_vector(self.latent, queries, k, metric=metric)
        named = rows._id_frame(self.latent, ids, "id")
        return knn.search_by_id(self.latent, named, k, metric=metric)

    # Tiles.

    @property
    def tiles(self) -> DataFrame:
        return self.table("tiles")

    @property
    def manifest(self) -> DataFrame:
        return tiles.manifest(self.tiles)

    def select_region(self, polygon) -> DataFrame:
        return tiles.select_region(self.tiles, polygon)

    def place(self, points: DataFrame, k: int = 15) -> DataFrame:
        """Positions of new ``id, vector`` rows on this map."""
        found = knn.search_by_vector(self.latent, points, k)
        return knn.place_new_points(found, self.projected)

    # Topics.

    @property
    def topic_metadata(self) -> DataFrame:
        return topics.metadata(self.table("topic_metadata"))

    @property
    def topics(self) -> DataFrame:
        return topics.label_topics(self.table("topics"), self.topic_metadata)

    @property
    def topic_hierarchy(self) -> DataFrame:
        return topics.hierarchy(self.topic_metadata)

    def group_by_topic(self, topic_depth: int = 1) -> DataFrame:
        return topics.group_by_topic(self.topics, self.topic_metadata, topic_depth)

    def topic_density(self, time_field: str, start, end, collapse: bool = False) -> DataFrame:
        timed = self.data([time_field, *topics.depth_columns(self.group("topics"))])
        return topics.topic_density(timed, time_field, start, end, collapse)

    def vector_search_topics(self, queries: DataFrame, k: int = 32, depth: int = 3) -> DataFrame:
        labelled = self.topics
        column = topics._check_depth(labelled, depth)
        found = knn.search_by_vector(self.latent, queries, k)
        return knn.topic_posterior(found, labelled, "id", column)

    # Duplicates.

    @property
    def duplicates(self) -> DataFrame:
        return self.table("duplicates")

    def deletion_candidates(self) -> DataFrame:
        return duplicates.deletion_candidates(self.duplicates)

    # Tags: bitmaps per block of seats. Each change writes a new version of the lines and of the levels done.

    def _tag_versions(self) -> list[dict]:
        return [p for p in self.dataset._payloads("tags") if p["map"] == self.path]

    def _read_tags(self) -> tuple[DataFrame, DataFrame]:
        """The newest lines ``tag, block, n, bits`` and levels done ``tag, level``."""
        spark, versions = self.dataset.spark, self._tag_versions()
        lines, done = "tag string, block string, n bigint, bits binary", "tag string, level int"
        if not versions:
            return spark.createDataFrame([], lines), spark.createDataFrame([], done)
        path = versions[-1]["path"]
        return spark.read.schema(lines).parquet(f"{path}/lines"), spark.read.schema(done).parquet(f"{path}/done")

    def _write_tags(self, lines: DataFrame, done: DataFrame) -> None:
        path = f"{self.path}/tags-{len(self._tag_versions())}-{dt.datetime.now().strftime('%H%M%S%f')}"
        sinks.write_version(lines, f"{path}/lines")
        sinks.write_version(done, f"{path}/done")
        self.dataset._log("tags", {"map": self.path, "path": path})

    @property
    def _blocks(self) -> DataFrame:
        return tag_blocks.blocks_of(self.group("seats"))

    def _lines_of(self, ids: DataFrame, names: list[str], levels: list[int] | None) -> DataFrame:
        seats = self.group("seats")
        there = seats if levels is None else seats.filter(F.col("level").isin(levels))
        named = ids.select("id").distinct().withColumn("tag", F.explode(F.array(*[F.lit(n) for n in names])))
        return tag_blocks.stored(there, tag_blocks.blocks_of(there), named)

    def add_tags(self, ids: DataFrame, names: list[str], levels: list[int] | None = None) -> None:
        """Give rows tags. With ``levels`` only rows of those levels of tiles are looked at, and a new tag stays incomplete,
        hence hidden, until all levels were; ids that the map doesn't hold are left out."""
        if not names:
            return
        lines, done = self._read_tags()
        seen = self._blocks.select("level").distinct()
        seen = seen if levels is None else seen.filter(F.col("level").isin(levels))
        named = seen.withColumn("tag", F.explode(F.array(*[F.lit(n) for n in names]))).select("tag", "level")
        more = self._lines_of(ids, names, levels)
        self._write_tags(tag_blocks.with_tags(lines, more, self._blocks), done.unionByName(named).distinct())

    def remove_tags(self, ids: DataFrame | None, names: list[str], delete_all: bool = False) -> None:
        """Take tags from rows; with ``delete_all`` the tags go altogether."""
        lines, done = self._read_tags()
        if delete_all:
            self._write_tags(*(df.filter(~F.col("tag").isin(names)) for df in (lines, done)))
        elif names:
            self._write_tags(tag_blocks.without_tags(lines, self._lines_of(ids, names, None), self._blocks), done)

    @property
    def tag_definitions(self) -> DataFrame:
        """``tag, complete`` of all tags."""
        return tag_blocks.definitions(self._read_tags()[1], self._blocks)

    def _complete_lines(self) -> DataFrame:
        return self._read_tags()[0].join(tags.list_tags(self.tag_definitions), "tag", "left_semi")

    @property
    def tags(self) -> DataFrame:
        """``id, tag`` of complete tags."""
        return tag_blocks.tagged_rows(self.group("seats"), self._complete_lines())

    @property
    def tag_counts(self) -> DataFrame:
        """``tag, n`` of complete tags, from the lines alone."""
        return tag_blocks.tag_sizes(self._complete_lines())

    def rows_in_tag(self, name: str) -> DataFrame:
        """Ids of a complete tag's rows; another name is an error."""
        tags.tag_by_name(self.tag_definitions, name)
        lines = self._read_tags()[0].filter(F.col("tag") == name)
        return tag_blocks.tagged_rows(self.group("seats"), lines).select("id")

    def tag_lists(self) -> DataFrame:
        """``id, tags`` of all rows: the sorted complete tags of each, however many tags there are."""
        held = self.tags.groupBy("id").agg(F.array_sort(F.collect_set("tag")).alias("tags"))
        return self.group("projected").select("id").join(held, "id", "left").withColumn("tags", F.coalesce("tags", F.array().cast("array<string>")))

    def tag_table(self) -> DataFrame:
        """Every id with one boolean column per complete tag; beyond a thousand tags use ``tag_lists``."""
        return tags.tag_table(self.projected, self.tags, self.tag_definitions)


def map_data(
    spark: SparkSession, root: str, identifier: str, data=None, embeddings=None, blobs: DataFrame | None = None, *,
    indexed_field: str | None = None, id_field: str | None = None, description: str = "", **build,
) -> Map:
    """Create a dataset of the fitting modality, load it and build its map.

    A failed first load drops the dataset again.
    """
    if isinstance(embeddings, np.ndarray) and embeddings.size == 0:
        raise ValueError("embeddings are empty")
    modality = _modality_of(indexed_field is not None, embeddings is not None, blobs is not None, build.get("embedder") is not None)
    if modality != "embedding":
        embeddings = None
    if modality == "image":
        indexed_field = None
    dataset = open_or_create(spark, root, identifier, modality, id_field, description)
    if dataset.total_datums > 0:
        raise ValueError("map_data cannot update a dataset that has rows")
    try:
        dataset.add_data(data, embeddings, blobs)
    except BaseException:
        dataset.drop()
        raise
    return dataset.create_index(identifier, indexed_field, **build)


def _modality_of(field: bool, vectors_given: bool, blobs: bool, embedder: bool) -> str:
    """What kind of dataset the given inputs make."""
    given = (field, vectors_given, blobs)
    if given == (False, True, True):
        raise ValueError("give blobs or embeddings, not both")
    if blobs and not embedder:
        raise ValueError("blobs need an image embedder")
    if field and vectors_given:
        warnings.warn("with an indexed_field the embeddings are ignored", stacklevel=3)
    return "image" if blobs else "text" if field else "embedding"


def open_or_create(spark, root, identifier, modality, id_field=None, description="") -> Dataset:
    """The dataset of that name; one that was dropped or does not exist is created, one of another kind is an error."""
    if not Dataset.exists(spark, root, identifier):
        return Dataset.create(spark, root, identifier, modality=modality, id_field=id_field, description=description)
    found = Dataset(spark, root, identifier)
    if (found.modality, found.id_field) != (modality, id_field):
        raise ValueError(f"{identifier!r} holds {found.modality} rows with id field {found.id_field!r}")
    return found

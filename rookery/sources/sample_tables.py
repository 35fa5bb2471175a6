"""The social tables read off the generated test tables (events, documents, ...).

Every rule is a plain expression of the source columns; ``k`` is the integer in
``events.props``, ``U`` the number of users and ``D`` the number of documents.
"""

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rookery.functions.scalar import full_name, post_id, wall_clock_ms
from rookery.plans.recommend import SocialTables

AS_OF = date(2024, 1, 15)

# A short stop-word list for the four languages of the documents.
STOP_WORDS = ("the", "of", "and", "to", "in", "is", "der", "die", "und", "de", "la", "le", "les", "el", "que")


def _name(user: Column) -> Column:
    return F.concat(F.lit("u"), user.cast("string"))


def _link(doc: Column) -> Column:
    return F.concat(F.lit("doc://"), doc.cast("string"))


class SampleTables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._sources: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._sources[name]

    @cached_property
    def n_documents(self) -> Column:
        return self.source("documents").agg(F.count("*")).scalar()

    @cached_property
    def n_users(self) -> Column:
        return self.source("events").agg(F.countDistinct("user_id")).scalar()

    def coded_events(self, events: DataFrame) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        return events.select(
            "event_id", "user_id", "event_type", "props", k.alias("k"), wall_clock_ms(F.col("ts")).alias("timestamp")
        )

    @cached_property
    def events(self) -> DataFrame:
        return self.coded_events(self.source("events"))

    def of_type(self, *types: str, events: DataFrame | None = None) -> DataFrame:
        rows = self.events if events is None else events
        return rows.where(F.col("event_type").isin(*types))

    @property
    def username(self) -> Column:
        return _name(F.col("user_id"))

    @property
    def signup_category(self) -> Column:
        return F.concat(F.lit("SRC"), (F.col("k") % 20).cast("string"))

    @property
    def event_link(self) -> Column:
        return _link((F.col("event_id") * 7 + F.col("k")) % self.n_documents)

    @property
    def event_friend(self) -> Column:
        return _name((F.col("user_id") + 1 + F.col("k")) % self.n_users)

    @cached_property
    def articles(self) -> DataFrame:
        return self.source("documents").select(
            F.col("lang").alias("author"),
            F.upper("source").alias("category"),
            F.date_add(F.lit(date(2024, 1, 1)), (F.col("doc_id") % 30).cast("int")).alias("date"),
            F.col("text").alias("headline"),
            _link(F.col("doc_id")).alias("link"),
            F.col("text").alias("description"),
        )

    @cached_property
    def user_ids(self) -> DataFrame:
        return self.source("events").select("user_id").distinct()

    @cached_property
    def users(self) -> DataFrame:
        """Profile columns; presence and interests come from their logs."""
        interest = F.when(F.col("event_type") == "signup", self.signup_category)
        per_user = self.events.groupBy("user_id").agg(
            F.max_by(F.col("event_type") != "error", F.struct("timestamp", "event_id")).alias("loggedin"),
            F.array_sort(F.collect_set(interest)).alias("interests"),  # at most 20 categories
        )
        number = F.col("user_id")
        return per_user.select(
            self.username.alias("username"),
            F.concat(F.lit("First"), number.cast("string")).alias("firstname"),
            F.concat(F.lit("Last"), (number % 7).cast("string")).alias("lastname"),
            F.concat(F.lit("aff"), (number % 5).cast("string")).alias("affiliation"),
            F.concat_ws("/", (number % 12 + 1).cast("string"), (number % 28 + 1).cast("string"), F.lit("1990")).alias(
                "birthday"
            ),
            "interests",
            "loggedin",
        )

    @cached_property
    def usernames(self) -> DataFrame:
        return self.user_ids.select(self.username.alias("username"))

    @cached_property
    def interests(self) -> DataFrame:
        return self.of_type("signup").select(self.username.alias("username"), self.signup_category.alias("category")).distinct()

    @cached_property
    def likes(self) -> DataFrame:
        return self.of_type("purchase").select(self.username.alias("username"), self.event_link.alias("link")).distinct()

    @cached_property
    def seen(self) -> DataFrame:
        return self.of_type("view").select(self.username.alias("username"), self.event_link.alias("link")).distinct()

    @cached_property
    def friend_log(self) -> DataFrame:
        return self.friend_log_of(self.events)

    def friend_log_of(self, events: DataFrame) -> DataFrame:
        action = F.when(F.col("event_type") == "click", "add").otherwise("remove")
        return (
            events.where("event_type in ('click', 'error')")
            .select(
                self.username.alias("username1"),
                self.event_friend.alias("username2"),
                action.alias("action"),
                "timestamp",
                F.col("event_id").alias("seq"),
            )
            .where("username1 <> username2")
        )

    @cached_property
    def friends(self) -> DataFrame:
        """Both directions of every friendship ever made, with its last time."""
        pair = F.explode(
            F.array(
                F.struct(F.col("username1").alias("a"), F.col("username2").alias("b")),
                F.struct(F.col("username2").alias("a"), F.col("username1").alias("b")),
            )
        )
        made = self.friend_log.where("action = 'add'").select(pair.alias("p"), "timestamp")
        return made.groupBy(F.col("p.a").alias("username1"), F.col("p.b").alias("username2")).agg(
            F.max("timestamp").alias("timestamp")
        )

    def like_log_of(self, events: DataFrame) -> DataFrame:
        delta = F.when(F.col("event_type") == "purchase", 1).otherwise(-1).cast("bigint")
        return events.where("event_type in ('purchase', 'error')").select(
            self.event_link.alias("link"), delta.alias("delta")
        )

    @cached_property
    def like_log(self) -> DataFrame:
        return self.like_log_of(self.events)

    @cached_property
    def liked_set_log(self) -> DataFrame:
        action = F.when(F.col("event_type") == "purchase", "add").otherwise("delete")
        return self.of_type("purchase", "error").select(
            self.username.alias("username"),
            F.concat(F.lit(" "), self.event_link).alias("element"),
            action.alias("action"),
            "timestamp",
            F.col("event_id").alias("seq"),
        )

    def presence_log_of(self, events: DataFrame) -> DataFrame:
        return events.select(
            self.username.alias("username"),
            (F.col("event_type") != "error").alias("loggedin"),
            "timestamp",
            F.col("event_id").alias("seq"),
        )

    @cached_property
    def presence_log(self) -> DataFrame:
        return self.presence_log_of(self.events)

    def affiliation_log_of(self, events: DataFrame) -> DataFrame:
        return self.of_type("view", events=events).select(
            self.username.alias("username"),
            F.concat(F.lit("aff"), (F.col("k") % 5).cast("string")).alias("affiliation"),
            "timestamp",
            F.col("event_id").alias("seq"),
        )

    @cached_property
    def affiliation_log(self) -> DataFrame:
        return self.affiliation_log_of(self.events)

    def profile_log_of(self, events: DataFrame) -> DataFrame:
        k = F.col("k").cast("string")
        field = F.when(F.col("event_type") == "view", "affiliation").when(F.col("event_type") == "click", "email").otherwise("password")
        value = (
            F.when(F.col("event_type") == "view", F.concat(F.lit("aff"), (F.col("k") % 5).cast("string")))
            .when(F.col("event_type") == "click", F.concat(self.username, F.lit("@mail"), k))
            .otherwise(F.sha2(F.concat(F.lit("secret"), k), 256))
        )
        return self.of_type("view", "click", "purchase", events=events).select(
            self.username.alias("username"), field.alias("field"), value.alias("value"), "timestamp", F.col("event_id").alias("seq")
        )

    @cached_property
    def profile_log(self) -> DataFrame:
        return self.profile_log_of(self.events)

    def interest_log_of(self, events: DataFrame) -> DataFrame:
        action = F.when(F.col("event_type") == "click", "add").otherwise("delete")
        return self.of_type("click", "error", events=events).select(
            self.username.alias("username"),
            action.alias("action"),
            F.concat(F.lit("src"), (F.col("k") % 25).cast("string")).alias("category"),
            "timestamp",
            F.col("event_id").alias("seq"),
        )

    @cached_property
    def interest_log(self) -> DataFrame:
        return self.interest_log_of(self.events)

    @cached_property
    def posts(self) -> DataFrame:
        """Wall posts as sent, before mirroring."""
        return self.of_type("view").select(
            self.username.alias("posterusername"),
            post_id(F.col("timestamp"), self.username).alias("postuniqueid"),
            "timestamp",
            F.col("props").alias("content"),
            _name((F.col("user_id") + F.col("k")) % self.n_users).alias("wallusername"),
        )

    def statusposts_of(self, events: DataFrame) -> DataFrame:
        return events.where("event_type = 'signup'").select(
            self.username.alias("posterusername"),
            post_id(F.col("timestamp"), self.username).alias("postuniqueid"),
            "timestamp",
            F.col("props").alias("content"),
        )

    @cached_property
    def statusposts(self) -> DataFrame:
        return self.statusposts_of(self.events)

    @cached_property
    def comments(self) -> DataFrame:
        """``error`` events comment on the status post of the ten they belong to."""
        post = self.of_type("signup").select(
            F.col("event_id").alias("post_event"), post_id(F.col("timestamp"), self.username).alias("postuniqueid")
        )
        made = self.of_type("error").select(
            (F.col("event_id") - F.col("event_id") % 10).alias("post_event"),
            self.username.alias("usernameofcommentor"),
            "timestamp",
            F.col("props").alias("content"),
        )
        return made.join(post, "post_event").select("usernameofcommentor", "postuniqueid", "timestamp", "content")

    @cached_property
    def visits(self) -> DataFrame:
        """Wall visits: every user's own, the walls they posted on, and the next user's."""
        own = self.usernames.select(F.col("username").alias("viewer"), F.col("username").alias("owner"))
        posted = self.posts.select(F.col("posterusername").alias("viewer"), F.col("wallusername").alias("owner"))
        following = self.user_ids.select(
            self.username.alias("viewer"), _name((F.col("user_id") + 1) % self.n_users).alias("owner")
        )
        return own.unionByName(posted).unionByName(following).distinct()

    @cached_property
    def usersearch(self) -> DataFrame:
        return self.user_ids.select(
            full_name(
                F.concat(F.lit("First"), F.col("user_id").cast("string")),
                F.concat(F.lit("Last"), (F.col("user_id") % 7).cast("string")),
            ).alias("fullname"),
            self.username.alias("username"),
        )

    @cached_property
    def search_terms(self) -> DataFrame:
        """Each user searches for their own first name, typed in lower case."""
        return self.user_ids.select(F.concat(F.lit("first"), F.col("user_id").cast("string")).alias("term"))

    @cached_property
    def queries(self) -> DataFrame:
        """Every user whose number divides by 100 asks for the whole text of a document."""
        asking = self.user_ids.where(F.col("user_id") % 100 == 0)
        texts = self.source("documents").select(F.col("doc_id").alias("asked"), "text")
        return asking.withColumn("asked", F.col("user_id") % self.n_documents).join(texts, "asked").select(
            F.col("user_id").alias("query_id"), self.username.alias("username"), "text"
        )

    @cached_property
    def stopwords(self) -> DataFrame:
        words = F.array(*[F.lit(w) for w in STOP_WORDS])
        return self.spark.range(1).select(F.explode(words).alias("word"))

    @cached_property
    def messages(self) -> DataFrame:
        return self.messages_of(self.source("conversations"))

    def messages_of(self, conversations: DataFrame) -> DataFrame:
        return conversations.select(
            F.col("conv_id").alias("roomuniqueid"),
            F.col("turn").alias("timestamp"),
            F.col("role").alias("sender"),
            F.col("text").alias("content"),
            F.col("turn").alias("seq"),
        )

    @cached_property
    def membership(self) -> DataFrame:
        return self.source("conversations").select(
            F.col("conv_id").alias("roomuniqueid"), F.col("role").alias("member")
        ).distinct()

    def room_log_of(self, events: DataFrame) -> DataFrame:
        """Users join room k on a view and leave it on an error."""
        action = F.when(F.col("event_type") == "view", "join").otherwise("leave")
        return self.of_type("view", "error", events=events).select(
            F.col("k").cast("bigint").alias("roomuniqueid"),
            self.username.alias("member"),
            action.alias("action"),
            "timestamp",
            F.col("event_id").alias("seq"),
        )

    @cached_property
    def room_log(self) -> DataFrame:
        return self.room_log_of(self.events)

    @cached_property
    def room_groups(self) -> DataFrame:
        """Member groups to look up: those of every room whose number divides by 100.

        Every third of them asks for one member more, who is in no room.
        """
        rooms = self.membership.where(F.col("roomuniqueid") % 100 == 0)
        groups = rooms.groupBy(F.col("roomuniqueid").alias("group_id")).agg(F.collect_list("member").alias("members"))
        stranger = F.when(F.col("group_id") % 300 == 0, F.array(F.lit("nobody"))).otherwise(F.array().cast("array<string>"))
        return groups.withColumn("members", F.concat("members", stranger))

    @cached_property
    def direct_messages(self) -> DataFrame:
        return self.of_type("click").select(
            self.username.alias("fromuser"), self.event_friend.alias("touser"), "timestamp", F.col("props").alias("message")
        )

    @cached_property
    def signups(self) -> DataFrame:
        return self.signups_of(self.source("customer"))

    def signups_of(self, customers: DataFrame) -> DataFrame:
        number = F.col("c_custkey")
        name = F.when(number % 25 == 0, "").when(number % 10 == 1, F.concat(F.lit("shared"), (number % 100).cast("string"))).otherwise(F.col("c_name"))
        segments = F.array(F.lit("building"), F.lit("MACHINERY"), F.lit("Automobile"))
        return customers.select(
            name.alias("username"),
            F.when(number % 31 == 0, "").otherwise(F.col("c_name")).alias("password"),
            F.lit("customer").alias("firstname"),
            F.concat(F.lit("no"), number.cast("string")).alias("lastname"),
            F.when(F.col("c_acctbal") < 0, "").otherwise(F.concat(F.col("c_name"), F.lit("@mail"))).alias("email"),
            F.concat(F.lit("nation"), F.col("c_nationkey").cast("string")).alias("affiliation"),
            F.lit("1/1/1990").alias("birthday"),
            F.col("c_mktsegment").alias("newsinterest1"),
            F.get(segments, (number % 3).cast("int")).alias("newsinterest2"),
            number.alias("seq"),
        )

    @cached_property
    def taken_names(self) -> DataFrame:
        return self.source("supplier").select(
            F.concat(F.lit("Customer#"), F.lpad((F.col("s_suppkey") * 10 + 2).cast("string"), 9, "0")).alias("username")
        )

    @cached_property
    def social(self) -> SocialTables:
        return SocialTables(self.usernames, self.interests, self.likes, self.seen, self.friends, self.articles)


# The categories the sample signups may declare.
SIGNUP_CATEGORIES = ("AUTOMOBILE", "BUILDING", "MACHINERY")

# The categories the sample interest changes may name.
SAMPLE_CATEGORIES = tuple(f"SRC{n}" for n in range(20))
